"""Data-quality gates as Spark jobs: expectation suites, referential checks,
the lineage contract, reconciliation, golden agreement and drift.

Every row rule of a table is evaluated in one aggregate pass
(``sum(when(fail))``); uniqueness is a ``groupBy().count() > 1``; nothing is
collected to the driver except the final small report.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C
from reelmart.sources.scratch import counted

# ---------------------------------------------------------------- FIXED VALUES
# Expectation suites: (kind, column(s), args, severity). Kinds: not_null,
# between (min, max; None = open), in_set (values), unique, compound_unique,
# row_count (min). NULLs pass between / in_set / unique.
SUITES: dict[str, list[tuple]] = {
    "bronze_asset_raw": [
        ("not_null", "asset_id", None, "CRITICAL"),
        ("not_null", "model_version", None, "CRITICAL"),
        ("between", "chunk_count", (1, None), "CRITICAL"),
    ],
    "dim_asset": [
        ("not_null", "asset_id", None, "CRITICAL"),
        ("unique", "asset_id", None, "CRITICAL"),
        ("not_null", "client_id", None, "CRITICAL"),
        ("in_set", "asset_type", ["RAW", "EDITED"], "CRITICAL"),
        ("not_null", "ingested_at", None, "HIGH"),
    ],
    "dim_client": [
        ("not_null", "client_id", None, "CRITICAL"),
        ("unique", "client_id", None, "CRITICAL"),
    ],
    "fact_chunk": [
        ("not_null", "chunk_id", None, "CRITICAL"),
        ("unique", "chunk_id", None, "CRITICAL"),
        ("between", "standalone_score", (1, 5), "CRITICAL"),
    ],
    "silver_chunk": [
        ("not_null", "chunk_id", None, "CRITICAL"),
        ("unique", "chunk_id", None, "CRITICAL"),
        ("between", "standalone_score", (1, 5), "CRITICAL"),
        ("not_null", "chunk_theme", None, "CRITICAL"),
        ("in_set", "sentiment", ["energetic", "frustrated", "aspirational", "neutral", "urgent",
                                 "calm"], "HIGH"),
        ("row_count", None, 1, "CRITICAL"),
    ],
    "bridge_chunk_compatibility": [
        ("not_null", "chunk_id", None, "HIGH"),
    ],
    "bridge_ad_chunk": [
        ("compound_unique", ["ad_id", "chunk_id", "position_in_ad"], None, "CRITICAL"),
        ("not_null", "ad_id", None, "HIGH"),
        ("not_null", "chunk_id", None, "HIGH"),
        ("not_null", "asset_id", None, "HIGH"),
        ("between", "position_in_ad", (1, None), "MEDIUM"),
        ("in_set", "chunk_role", ["hook", "body", "social_proof", "cta"], "HIGH"),
    ],
    "fact_ad_performance": [
        ("not_null", "ad_id", None, "CRITICAL"),
        ("in_set", "platform_id", ["meta", "tiktok"], "CRITICAL"),
        ("between", "impressions", (0, None), "CRITICAL"),
        ("between", "spend", (0, None), "CRITICAL"),
        ("between", "plays_3s", (0, None), "CRITICAL"),
    ],
    "mart_chunk_perf_correlation": [
        ("not_null", "honesty_note", None, "CRITICAL"),
        ("in_set", "evidence_regime", ["BLOCK", "DIRECTIONAL", "SUGGESTIVE"], "CRITICAL"),
        ("between", "n_ads", (1, None), "HIGH"),
    ],
    # release gates of the performance marts
    "fct_ad_kpi": [
        ("between", "hook_rate", (0, 1), "CRITICAL"),
        ("between", "hold_rate_25", (0, 1), "CRITICAL"),
        ("between", "hold_rate_50", (0, 1), "CRITICAL"),
        ("between", "ctr_link", (0, 1), "CRITICAL"),
        ("between", "cvr", (0, 1), "CRITICAL"),
    ],
    "fct_ad_metric_chunk": [
        ("compound_unique", ["ad_id", "platform_id", "metric_name"], None, "CRITICAL"),
    ],
    "assembled_sequence": [
        ("between", "standalone_score", (4, None), "CRITICAL"),
    ],
}
#: expectation types of suite files: (rule kind, arguments required, arguments allowed beside)
SUITE_FILE_TYPES = {
    "expect_column_values_to_not_be_null": ("not_null", {"column"}, set()),
    "expect_column_values_to_be_between": ("between", {"column"}, {"min_value", "max_value"}),
    "expect_column_values_to_be_in_set": ("in_set", {"column", "value_set"}, set()),
    "expect_column_values_to_be_unique": ("unique", {"column"}, set()),
    "expect_compound_columns_to_be_unique": ("compound_unique", {"column_list"}, set()),
    "expect_table_row_count_to_be_between": ("row_count", {"min_value"}, set()),
}
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM"]
# ------------------------------------------------------------ end FIXED VALUES

ROW_KINDS = ("not_null", "between", "in_set")


def suite_of(file: dict) -> tuple[str, list[tuple]]:
    """(name, rules) of one suite file. What a rule can't express is an error,
    never skipped: a gate that is not understood would pass."""
    name = file["expectation_suite_name"]
    rules = []
    for e in file["expectations"]:
        kind, need, may = SUITE_FILE_TYPES.get(e["expectation_type"], (None, set(), set()))
        args, severity = e.get("kwargs", {}), e.get("meta", {}).get("severity")
        if kind is None:
            raise ValueError(f"suite {name}: unknown expectation {e['expectation_type']}")
        if not need <= set(args) <= need | may or may and not may & set(args):
            raise ValueError(f"suite {name}: {e['expectation_type']} can't take {sorted(args)}")
        if severity not in SEVERITIES:
            raise ValueError(f"suite {name}: severity {severity} of {e['expectation_type']}")
        wanted = {"between": (args.get("min_value"), args.get("max_value")), "in_set": args.get("value_set"),
                  "row_count": args.get("min_value")}.get(kind)
        rules.append((kind, args.get("column") or args.get("column_list"), wanted, severity))
    return name, rules


def file_of(name: str, rules: list[tuple]) -> dict:
    """The suite file of rules: what ``suite_of`` reads."""
    types = {kind: t for t, (kind, _, _) in SUITE_FILE_TYPES.items()}
    out = []
    for kind, cols, args, severity in rules:
        kwargs = {"column_list" if kind == "compound_unique" else "column": cols} if cols else {}
        if kind == "between":
            kwargs |= {k: v for k, v in zip(("min_value", "max_value"), args) if v is not None}
        elif kind in ("in_set", "row_count"):
            kwargs["value_set" if kind == "in_set" else "min_value"] = args
        out.append({"expectation_type": types[kind], "kwargs": kwargs, "meta": {"severity": severity}})
    return {"expectation_suite_name": name, "expectations": out}


def read_suites(spark: SparkSession, folder: str) -> dict[str, list[tuple]]:
    """Suites from the JSON files of a folder, a suite each."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    suites = [suite_of(json.loads(r[0])) for r in files.collect()]
    twice = {n for i, (n, _) in enumerate(suites) if n in [m for m, _ in suites[:i]]}
    if twice:
        raise ValueError(f"suites in two files: {sorted(twice)}")
    return dict(sorted(suites))


def checked_columns(name: str, df: DataFrame, rules: list[tuple]) -> None:
    named = {c for _, cols, _, _ in rules if cols for c in (cols if isinstance(cols, list) else [cols])}
    if named - set(df.columns):
        raise ValueError(f"suite {name}: the table has no column {sorted(named - set(df.columns))}")


def failing_rows(name: str, df: DataFrame, key: list[str], most: int = 20,
                 rules: list[tuple] | None = None) -> DataFrame:
    """Up to ``most`` offending rows of each rule (the first by ``key``), for
    whoever has to mend them: suite, expectation, severity, sample_rank, the key
    and the whole row as JSON. One pass for all row rules; each task keeps
    ``most`` rows a rule before the shuffle. A value that is not unique gives
    one row for each of its rows."""
    rules = SUITES[name] if rules is None else rules
    checked_columns(name, df, rules)
    label = lambda i: (F.lit(i).alias("rule"), F.lit(_label(*rules[i][:3])).alias("expectation"),
                       F.lit(rules[i][3]).alias("severity"))
    row = F.to_json(F.struct(*df.columns)).alias("row")
    hits = [F.when(_row_fail(*rules[i][:3]), F.struct(*label(i)))
            for i, r in enumerate(rules) if r[0] in ROW_KINDS]
    parts = []
    if hits:
        parts.append(df.select(*key, row, F.explode(F.array_compact(F.array(*hits))).alias("h"))
                     .select("h.*", *key, "row"))
    for i, (kind, cols, _, _) in enumerate(rules):
        if kind in ("unique", "compound_unique"):
            cols = cols if isinstance(cols, list) else [cols]
            again = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
            parts.append(df.withColumn("_row", row).join(again, cols, "left_semi")
                         .select(*label(i), *key, F.col("_row").alias("row")))
    w = Window.partitionBy("rule").orderBy(*key, "row")
    return (reduce(DataFrame.unionByName, parts).withColumn("sample_rank", F.row_number().over(w))
            .where(F.col("sample_rank") <= most)
            .select(F.lit(name).alias("suite"), "expectation", "severity", "sample_rank", *key, "row"))


def _label(kind: str, cols, args) -> str:
    c = ",".join(cols) if isinstance(cols, list) else (cols or "")
    return f"{kind}({c})"


def _row_fail(kind: str, col: str, args) -> F.Column:
    c = F.col(col)
    if kind == "not_null":
        return c.isNull()
    if kind == "between":
        lo, hi = args
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (c < lo)
        if hi is not None:
            cond = cond | (c > hi)
        return c.isNotNull() & cond
    if kind == "in_set":
        return c.isNotNull() & ~c.isin(*args)
    raise ValueError(kind)


def run_suite(name: str, df: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """Evaluate one suite: one aggregate for row rules, one per uniqueness rule."""
    rules = SUITES[name] if rules is None else rules
    checked_columns(name, df, rules)
    row_rules = [r for r in rules if r[0] in ROW_KINDS]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(_row_fail(k, c, a)).alias(f"f{i}") for i, (k, c, a, _) in
             enumerate(row_rules)]
    lines = [(k, c, a, sev, F.col(f"f{i}")) for i, (k, c, a, sev) in enumerate(row_rules)]
    lines += [(k, c, a, sev, F.when(F.col("n") < a, 1).otherwise(0).cast("bigint"))
              for k, c, a, sev in rules if k == "row_count"]
    parts = []
    if lines:
        # the one aggregate row is turned into a row per rule: the table is read once
        each = F.array(*[F.struct(F.lit(_label(k, c, a)).alias("expectation"), F.lit(sev).alias("severity"),
                                  F.col("n").alias("n_checked"), failed.cast("bigint").alias("n_failed"))
                         for k, c, a, sev, failed in lines])
        parts.append(df.agg(*aggs).select(F.inline(each)).select(F.lit(name).alias("suite"), "*"))
    for k, c, a, sev in rules:
        if k in ("unique", "compound_unique"):
            cols = c if isinstance(c, list) else [c]
            keyed = df.where(reduce(lambda x, y: x & y, [F.col(x).isNotNull() for x in cols]))
            parts.append(keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).agg(
                F.lit(name).alias("suite"), F.lit(_label(k, c, a)).alias("expectation"),
                F.lit(sev).alias("severity"),
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_checked"),
                F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint")
                .alias("n_failed")))
    return reduce(DataFrame.unionByName, parts)


def expectations_report(tables: dict[str, DataFrame], suites: dict[str, list[tuple]] | None = None
                        ) -> DataFrame:
    """All suites (of files, if given); ``blocks_promotion`` when a CRITICAL
    expectation fails. A suite without its table is an error. Each suite is a job
    of its own, whose few rows are stored: what one has shuffled is gone before
    the next begins."""
    suites = {n: SUITES[n] for n in tables} if suites is None else suites
    if set(suites) - set(tables):
        raise ValueError(f"no table for suites {sorted(set(suites) - set(tables))}")
    rep = reduce(DataFrame.unionByName, [counted(run_suite(n, tables[n], r), "suite-report")[0]
                                         for n, r in suites.items() if r])
    return rep.select("suite", "expectation", "severity", "n_checked", "n_failed",
                      (F.col("n_failed") == 0).alias("success"),
                      ((F.col("n_failed") > 0) & (F.col("severity") == "CRITICAL"))
                      .alias("blocks_promotion"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None
            ) -> DataFrame:
    """Child rows whose non-null key has no parent (left anti)."""
    pk = parent_key or key
    p = parent.select(F.col(pk).alias(key))
    return child.where(F.col(key).isNotNull()).join(p, key, "left_anti")


def unknown_tags(rows: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Rows whose tag is missing or not one of ``known``."""
    return rows.where(F.col(column).isNull() | ~F.col(column).isin(*known))


def referential_report(checks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """``checks``: (name, severity, frame of offending rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_orphans"))
             .select(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), "n_orphans")
             for n, s, df in checks]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("n_orphans") == 0)


def lineage_violations(manifest_rows: DataFrame, clients: DataFrame) -> DataFrame:
    """Lineage contract R1-R7 over manifest rows: (rule, asset_id, detail).

    R1 required non-empty; R2 64-hex ids; R3 identity formula; R4 URI grammar
    and segment match; R5 client exists; R6 asset_id unique; R7 client is no
    placeholder. One projection flags R1-R5 and R7; R6 is an aggregate.
    """
    m = manifest_rows.join(clients.select("client_id").withColumn("_known", F.lit(True)),
                           "client_id", "left")
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    req = ["asset_id", "client_id", "content_sha256", "asset_type", "source_uri"]
    aid, sha, cid, uri = (F.coalesce(F.trim(F.col(c)), F.lit("")) for c in
                          ("asset_id", "content_sha256", "client_id", "source_uri"))
    hexok = lambda c: c.rlike(S.HEX64_PATTERN)
    uri_client = F.regexp_extract(uri, S.URI_PATTERN, 3)
    uri_hash = F.regexp_extract(uri, S.URI_PATTERN, 4)
    uri_ok = uri.rlike(S.URI_PATTERN)
    v = F.array_compact(F.array(
        F.when(reduce(lambda x, y: x | y, [blank(c) for c in req]),
               F.concat(F.lit("R1|"), F.concat_ws(",", *[F.when(blank(c), F.lit(c)) for c in req]))),
        F.when(~hexok(aid) | ~hexok(sha), F.lit("R2|id not 64-hex")),
        F.when(hexok(sha) & (cid != "") & (C.asset_identity(cid, sha) != aid),
               F.lit("R3|asset_id != sha256(client:content)")),
        F.when(~uri_ok, F.lit("R4|uri grammar"))
        .when((uri_client != cid) | (uri_hash != aid), F.lit("R4|uri segment mismatch")),
        F.when((cid != "") & F.col("_known").isNull(), F.lit("R5|unknown client")),
        F.when(cid.isin(*S.PLACEHOLDER_CLIENTS), F.lit("R7|placeholder client")),
    ))
    rows = m.select("asset_id", F.explode(v).alias("x")).select(
        F.substring_index("x", "|", 1).alias("rule"), "asset_id",
        F.substring_index("x", "|", -1).alias("detail"))
    dup = (manifest_rows.groupBy("asset_id").agg(F.count(F.lit(1)).alias("k"))
           .where(F.col("k") > 1)
           .select(F.lit("R6").alias("rule"), "asset_id",
                   F.concat(F.lit("duplicate x"), F.col("k").cast("string")).alias("detail")))
    return rows.unionByName(dup)


def lineage_contract_summary(violations: DataFrame, spark) -> DataFrame:
    """Violations per rule, all seven rules listed (0 when clean)."""
    rules = C.literal_table(spark, [(f"R{i}",) for i in range(1, 8)], "rule string")
    cnt = violations.groupBy("rule").agg(F.count(F.lit(1)).alias("n_violations"))
    return rules.join(cnt, "rule", "left").select(
        "rule", F.coalesce("n_violations", F.lit(0)).cast("bigint").alias("n_violations"))


def reconcile(name: str, base: DataFrame, view: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts and key multisets of a view against its base.

    Equivalent to ``exceptAll`` both ways, in one pass: the keys of both sides
    are counted together, each by its side, and the surpluses are summed.
    """
    side = lambda df, b, v: df.select(*keys, F.lit(b).alias("_b"), F.lit(v).alias("_v"))
    j = side(base, 1, 0).unionByName(side(view, 0, 1)).groupBy(*keys).agg(
        F.sum("_b").alias("cb"), F.sum("_v").alias("cv"))
    return (j.agg(F.sum("cb").cast("bigint").alias("n_base"),
                  F.sum("cv").cast("bigint").alias("n_view"),
                  F.sum(F.greatest(F.col("cb") - F.col("cv"), F.lit(0))).cast("bigint")
                  .alias("n_base_only"),
                  F.sum(F.greatest(F.col("cv") - F.col("cb"), F.lit(0))).cast("bigint")
                  .alias("n_view_only"))
            .select(F.lit(name).alias("check_name"), "n_base", "n_view", "n_base_only",
                    "n_view_only",
                    ((F.col("n_base_only") == 0) & (F.col("n_view_only") == 0)).alias("reconciled")))


def _items() -> F.Column:
    """The items of a chunk: its theme and its keywords."""
    return F.concat(F.array(F.concat(F.lit("t:"), "chunk_theme")),
                    F.coalesce(F.transform("keywords", lambda k: F.concat(F.lit("k:"), k)), F.array().cast("array<string>")))


def golden_gate(run1: DataFrame, run2: DataFrame, assets: DataFrame) -> DataFrame:
    """Agreement of two extraction runs per client: mean per-asset Jaccard of
    (theme, keyword) sets and score agreement within +/-1 on common chunks.

    Chunks of both runs are dealt out by asset once, whole; their items come
    apart behind the shuffle and are counted there, each by the runs that have
    it - no set is ever collected into one row. A missing item equals no other.
    """
    side = lambda run, a, b: run.select("asset_id", "chunk_theme", "keywords",
                                        F.lit(a).alias("a"), F.lit(b).alias("b"))
    each = (side(run1, True, False).unionByName(side(run2, False, True)).repartition("asset_id")
            .select("asset_id", "a", "b", F.explode(_items()).alias("item"))
            .groupBy("asset_id", "item").agg(F.max("a").alias("a"), F.max("b").alias("b")))
    both, known = F.col("a") & F.col("b"), F.col("item").isNotNull()
    j = (each.groupBy("asset_id")
         .agg(F.count_if(both & known).alias("n_inter"),
              (F.count(F.lit(1)) + F.count_if(both & ~known)).alias("n_union"))
         .withColumn("jaccard", C.safe_ratio("n_inter", "n_union")))
    s = (run1.select("asset_id", "chunk_sequence", F.col("standalone_score").alias("s1"))
         .join(run2.select("asset_id", "chunk_sequence", F.col("standalone_score").alias("s2")),
               ["asset_id", "chunk_sequence"])
         .groupBy("asset_id")
         .agg(F.count(F.lit(1)).alias("n_common"),
              F.count_if(F.abs(F.col("s1") - F.col("s2")) <= S.GOLDEN_SCORE_TOLERANCE)
              .alias("n_within")))
    per = j.join(s, "asset_id", "left").join(assets.select("asset_id", "client_id"), "asset_id")
    return (per.groupBy("client_id")
            .agg(F.count(F.lit(1)).alias("n_assets"), F.avg("jaccard").alias("mj"),
                 F.sum("n_common").alias("n_common"), F.sum("n_within").alias("n_within"))
            .select("client_id", "n_assets", C.r6(F.col("mj")).alias("mean_jaccard"),
                    C.r6(C.safe_ratio("n_within", "n_common")).alias("score_agreement"),
                    ((F.col("mj") >= S.GOLDEN_MIN_JACCARD)
                     & (F.col("n_within") == F.col("n_common"))).alias("passes")))


def drift_report(run1: DataFrame, run2: DataFrame) -> DataFrame:
    """Re-extraction drift per asset (signal only): a full outer join on
    (asset, sequence) counts missing, new and changed chunks."""
    a = run1.select("asset_id", "chunk_sequence", F.col("standalone_score").alias("s1"),
                    F.col("chunk_theme").alias("t1"), F.lit(1).alias("in1"))
    b = run2.select("asset_id", "chunk_sequence", F.col("standalone_score").alias("s2"),
                    F.col("chunk_theme").alias("t2"), F.lit(1).alias("in2"))
    j = a.join(b, ["asset_id", "chunk_sequence"], "full")
    both = F.col("in1").isNotNull() & F.col("in2").isNotNull()
    return (j.groupBy("asset_id")
            .agg(F.count("in1").alias("n_run1"), F.count("in2").alias("n_run2"),
                 F.count_if(F.col("in2").isNull()).alias("n_missing"),
                 F.count_if(F.col("in1").isNull()).alias("n_new"),
                 F.count_if(both & (F.col("s1") != F.col("s2"))).alias("n_score_changed"),
                 F.count_if(both & (F.col("t1") != F.col("t2"))).alias("n_theme_changed"))
            .withColumn("drifted", (F.col("n_missing") + F.col("n_new") + F.col("n_score_changed")
                                    + F.col("n_theme_changed")) > 0))
