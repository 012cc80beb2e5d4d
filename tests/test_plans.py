"""Plan checks: pushdown, pruning, no cartesian products, no Python UDFs in
relational keys, partial aggregation where a hot key may land."""

import pytest

import __spark_entry__ as E
from reelmart.plans.registry import QUERIES
from tests.conftest import SF_SMALL



def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


WRITES = {"seed_tables", "perf_raw_capture", "bronze_append", "manifest_append", "silver_store",
          "quarantine_store", "run_log_scan", "frozen_log_store", "landing_scan"}


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith("stream_")
                                       and k not in WRITES))
def test_no_cartesian_and_no_python(spark, key):
    p = plan_of(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p, key
    assert "Python" not in p and "InPandas" not in p and "InArrow" not in p, key


def test_search_pushes_filters_and_prunes(spark):
    from reelmart.operators import search as SR
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    chunks = df.selectExpr("cast(doc_id as string) as chunk_id", "source as asset_id",
                           "text as transcript_segment", "lang as chunk_theme",
                           "lang as sentiment", "cast(n_chars as int) as standalone_score",
                           "0.0 as start_sec", "1.0 as end_sec")
    assets = df.selectExpr("source as asset_id", "lang as asset_name", "source as client_id")
    p = plan_of(SR.search_clips(chunks, assets, theme="en", min_score=100, contains="the"))
    assert "EqualTo(lang,en)" in p                       # equality reaches the scan
    assert "ReadSchema: struct<lang:string,source:string>" in p  # asset side pruned to 2 cols


def test_alignment_pick_is_an_aggregate_not_a_sort(spark):
    p = plan_of(E.queries()["metric_chunk_alignment"](spark, SF_SMALL))
    assert "min_by" in p and "partial_min_by" in p


def test_pair_topk_prunes_before_the_join(spark):
    p = plan_of(E.queries()["compatible_pairs_topk"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_a_suite_reads_its_table_once(spark):
    from reelmart.operators import quality as Q
    from reelmart.plans.registry import fact_chunk, lake
    df = Q.run_suite("fact_chunk", fact_chunk(lake(spark, SF_SMALL)))
    rows = [k for k in Q.SUITES["fact_chunk"] if k[0] not in ("unique", "compound_unique")]
    assert len(rows) > 1
    # one scan for all row rules, one for each uniqueness rule
    assert plan_of(df).count("FileScan") == 1 + len(Q.SUITES["fact_chunk"]) - len(rows)


def test_client_scope_prunes_silver_partitions(spark):
    from reelmart.operators import search as SR
    from reelmart.plans.registry import lake, silver_wide
    lk = lake(spark, SF_SMALL)
    df = SR.search_clips(silver_wide(lk), lk.manifest, theme="Hook", client_id="src0")
    p = plan_of(df)
    assert "PartitionFilters: [isnotnull(client_id" in p and "(client_id" in p and "= src0)" in p
    assert df.count() == SR.search_clips(silver_wide(lk).drop("client_id"), lk.manifest,
                                         theme="Hook", client_id="src0").count()
