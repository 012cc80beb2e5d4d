"""Alignment, assembly, ranks and suite files against brute force."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from reelmart.functions.ranks import average_rank, exact_median, value_ranks
from reelmart.operators import align as AL
from reelmart.operators import assemble as A
from reelmart.operators import quality as Q
from tests.test_plans import plan_of

CHUNK = "ad_id string, chunk_id string, chunk_role string, position_in_ad int, start_sec double, end_sec double"
ANCHOR = "ad_id string, platform_id string, metric_name string, anchor_sec double"


# alignment ------------------------------------------------------------------------
def brute_owner(a, chunks, tolerance):
    """The rule, chunk by chunk."""
    def rank(c):
        _, cid, role, pos, s, e = c
        if a is None:
            return (float("inf"), pos, cid)
        inside = s is not None and e is not None and s <= a < e
        low = max(x for x in (s, a) if x is not None)
        high = min(x for x in (e, a) if x is not None)
        return (-1.0 if inside else low - high, pos, cid)
    best = min(chunks, key=rank)
    away = rank(best)[0]
    cov = ("LOW" if a is None else "HIGH" if away == -1 else
           "LOW" if tolerance is not None and away > tolerance else "MEDIUM")
    return best[1], best[2], cov


@pytest.mark.parametrize("tolerance", [None, 3.0])
def test_alignment_equals_brute_force(spark, tolerance):
    rng = random.Random(11)
    chunks, anchors = [], []
    for ad in range(40):
        n, at = rng.randint(0, 9), 0.0
        for i in range(n):
            s = at + rng.choice([0, 0, 1, 4])
            e = s + rng.choice([0, 1, 2, 5])
            at = e
            if ad % 3 == 0:  # overlapping, turned round or missing bounds, ties of position
                s, e = (rng.choice([None, s, rng.randint(0, 20)]), rng.choice([None, e, rng.randint(0, 20)]))
            chunks.append((f"ad{ad}", f"ad{ad}_{i}", rng.choice(["hook", "body", "cta"]), rng.choice([i, 1]),
                           None if s is None else float(s), None if e is None else float(e)))
        for p, m in itertools.product("mt", ["h", "q1", "q2", "q3", "q4"]):
            anchors.append((f"ad{ad}", p, m, rng.choice([None, *map(float, range(0, 24)), 2.5, 7.25])))
    b, anc = spark.createDataFrame(chunks, CHUNK).repartition(5), spark.createDataFrame(anchors, ANCHOR)
    out = AL.metric_chunk_alignment(anc, b, anc.select("ad_id", "platform_id"), tolerance)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in out.where("metric_name <> 'ctr_link'").collect()}
    by = {k: list(g) for k, g in itertools.groupby(chunks, key=lambda c: c[0])}
    assert got == {(ad, p, m): brute_owner(a, by[ad], tolerance) for ad, p, m, a in anchors if ad in by}


def test_alignment_of_a_hot_ad_is_linear(spark):
    """A million chunks of one ad: a few small rows each, reduced before any shuffle."""
    n = 1_000_000
    b = spark.range(n, numPartitions=8).select(
        F.lit("hot").alias("ad_id"), F.format_string("c%07d", "id").alias("chunk_id"), F.lit("body").alias("chunk_role"),
        F.col("id").cast("int").alias("position_in_ad"), (F.col("id") * 2.0).alias("start_sec"),
        (F.col("id") * 2.0 + 1.5).alias("end_sec"))
    marks = [0.0, 1.6, 1.9, 77.0, 1_000_001.0, 1_999_999.7, 5e6]
    anc = spark.createDataFrame([("hot", "m", f"x{i}", a) for i, a in enumerate(marks)], ANCHOR)
    out = AL.metric_chunk_alignment(anc, b, anc.select("ad_id", "platform_id"))
    got = {r.metric_name: (r.chunk_id, r.coverage_confidence) for r in out.collect()}
    assert got == {"x0": ("c0000000", "HIGH"), "x1": ("c0000000", "MEDIUM"), "x2": ("c0000001", "MEDIUM"),
                   "x3": ("c0000038", "HIGH"), "x4": ("c0500000", "HIGH"), "x5": ("c0999999", "MEDIUM"),
                   "x6": ("c0999999", "MEDIUM")}


# assembly -------------------------------------------------------------------------
def brute_assembly(chunks, compat, depth, k, most, last):
    """Every path of the walk, then the best of each hook."""
    themes = sorted({c[2] for c in chunks})
    rank = {(cl, t): sorted([c for c in chunks if c[4] == cl and c[2] == t and c[3] >= 4], key=lambda c: (-c[3], c[0]))
            for cl in {c[4] for c in chunks} for t in themes}
    out = []
    for hook in [c for c in chunks if c[2] == "Hook" and c[3] >= 4]:
        paths = [[hook]]
        for step in range(1, depth):
            grown = []
            for p in paths:
                for t in sorted({t for c, t in compat if c == p[-1][0]}):
                    if last and step == depth - 1 and t != last:
                        continue
                    free = [c for c in rank.get((hook[4], t), []) if c not in p]
                    grown += [p + [c] for c in free[:k]]
            paths = grown
        keyed = sorted((-sum(c[3] for c in p), "".join(c[0] + ">" for c in p)) for p in paths)
        out += [(hook[0], key[:-1], -score) for score, key in keyed[:most]]
    return sorted(out)


@pytest.mark.parametrize("depth,k,most,last", [(3, 2, 20, "CTA"), (4, 2, 5, None), (5, 2, 3, None), (5, 3, 7, "CTA"),
                                                (4, 1, 2, None), (6, 2, 4, None), (2, 3, 2, None)])
def test_assembly_equals_brute_force(spark, depth, k, most, last):
    rng = random.Random(depth * 100 + k)
    themes = ["Hook", "Body", "Proof", "CTA"]
    chunks, compat = [], []
    for client, n in (("a", 9), ("b", 26), ("c", 4)):
        for i in range(n):
            cid = f"{client}_{rng.choice([i, i * 37])}_{i}"  # ids of unlike length, some the beginning of others
            chunks.append((cid, f"{client}{i % 3}", rng.choice(themes), rng.choice([3, 4, 4, 5, 9]), client))
            compat += [(cid, t) for t in rng.sample(themes, rng.randint(0, 3))]
    c = spark.createDataFrame(chunks, "chunk_id string, asset_id string, chunk_theme string, standalone_score int, client_id string")
    e = spark.createDataFrame(compat, "chunk_id string, compatible_theme string")
    got = A.assemble(c, None, e, depth=depth, k=k, most=most, last_theme=last, checkpoint_every=2)
    rows = sorted((r.hook_chunk, r.sequence, r.sequence_score) for r in got.collect())
    assert rows == brute_assembly(chunks, compat, depth, k, most, last)


def test_bounds_keep_few_paths(spark):
    """The walk stays narrow although nothing is cut that could win."""
    rng = random.Random(1)
    themes = ["Hook", "Body", "Proof", "CTA"]
    chunks = [(f"c{i:04}", "x", themes[i % 4], 4 + rng.randint(0, 1), "cl") for i in range(400)]
    c = spark.createDataFrame(chunks, "chunk_id string, asset_id string, chunk_theme string, standalone_score int, client_id string")
    e = spark.createDataFrame([(x[0], t) for x in chunks for t in themes], "chunk_id string, compatible_theme string")
    cand = A.top_candidates(A.eligible_chunks(c, None), 2 + 4).select(
        "client_id", F.col("chunk_theme").alias("step_theme"), F.col("chunk_id").alias("cand_chunk"),
        F.col("standalone_score").alias("cand_score"), "theme_rank")
    ahead = A.to_go(cand, e, 5, None)
    paths = A.eligible_chunks(c, None).where("chunk_theme = 'Hook'").select(
        "client_id", F.col("chunk_id").alias("hook"), F.array("chunk_id").alias("path"),
        F.array("chunk_theme").alias("themes"), F.col("standalone_score").alias("score"),
        F.col("chunk_id").alias("last_chunk")).withColumn("path_key", F.concat("last_chunk", F.lit(">")))
    for step in (1, 2):
        paths = A._extend(paths, cand.drop("theme_rank"), e, 2)
    n = paths.count()
    kept = A.still_open(paths, *ahead[1], 20).count()
    assert n == 100 * 64 and 100 * 20 <= kept <= 100 * 40


# ranks ----------------------------------------------------------------------------
@pytest.mark.parametrize("most,buckets", [(3, 2), (1, 4), (50, 64)])
def test_ranges_are_split_until_they_are_small(spark, most, buckets):
    from pyspark.sql import Window
    rows = [(g, float((i * 7919) % n), i) for g, n in (("hot", 211), ("cold", 5), ("one", 1)) for i in range(600)]
    d = spark.createDataFrame(rows, "g string, v double, i long")
    r = value_ranks(d, ["g"], "v", buckets, most)
    w = Window.partitionBy("g").orderBy("v")
    ties = F.count(F.lit(1)).over(Window.partitionBy("g", "v"))
    want = {tuple(x) for x in d.select("g", "v", F.rank().over(w) + (ties - 1) / 2.0).distinct().collect()}
    assert {tuple(x) for x in r.select("g", "v", average_rank(r)).collect()} == want
    got = {x.g: x.median for x in exact_median(d, ["g"], "v", buckets, most).collect()}
    assert got == {x.g: x.m for x in d.groupBy("g").agg(F.median("v").alias("m")).collect()}


def test_a_group_of_ten_million_values_is_split(spark):
    """One group of 10,000,000 distinct values: no range over the bound."""
    from reelmart.functions.ranks import split_ranges
    n, most = 10_000_000, 200_000
    counts = spark.range(n, numPartitions=8).select(F.lit("g").alias("g"), (F.col("id") * 1.5).alias("v"),
                                                    F.lit(1).cast("long").alias("t"))
    sizes = split_ranges(counts, n, ["g"], "v", 64, most).groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_bucket").collect()
    assert sum(r.n for r in sizes) == n and max(r.n for r in sizes) <= most
    assert all(a.hi < b.lo for a, b in itertools.pairwise(sizes))  # ranges in the order of the values


# suites ---------------------------------------------------------------------------
def test_suites_round_trip_through_files(spark, tmp_path):
    for name, rules in Q.SUITES.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(Q.file_of(name, rules)))
    (tmp_path / "notes.txt").write_text("not a suite")
    assert Q.read_suites(spark, str(tmp_path)) == dict(sorted(Q.SUITES.items()))


def test_a_new_suite_file_reports_without_code(spark, tmp_path):
    rules = [{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "x", "max_value": 2},
              "meta": {"severity": "CRITICAL", "why": "a reason"}},
             {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "k"},
              "meta": {"severity": "HIGH"}}]
    (tmp_path / "extra.json").write_text(json.dumps(
        {"expectation_suite_name": "my_table", "meta": {"layer": "gold"}, "expectations": rules}, indent=1))
    df = spark.createDataFrame([("a", 1), ("b", 3), ("b", None)], "k string, x int")
    suites = Q.read_suites(spark, str(tmp_path))
    rep = [tuple(r) for r in Q.expectations_report({"my_table": df, "other": df}, suites).collect()]
    assert sorted(rep) == [("my_table", "between(x)", "CRITICAL", 3, 1, False, True),
                           ("my_table", "unique(k)", "HIGH", 3, 2, False, False)]
    rows = [tuple(r) for r in Q.failing_rows("my_table", df, ["k"], 5, suites["my_table"]).collect()]
    assert [(r[1], r[3], r[4], json.loads(r[5])) for r in sorted(rows)] == [
        ("between(x)", 1, "b", {"k": "b", "x": 3}), ("unique(k)", 1, "b", {"k": "b", "x": 3}),
        ("unique(k)", 2, "b", {"k": "b"})]


@pytest.mark.parametrize("change", [
    {"expectation_type": "expect_column_values_to_match_regex"}, {"kwargs": {"column": "x", "mostly": 0.9, "min_value": 0}},
    {"kwargs": {"column": "x"}}, {"kwargs": {"min_value": 1}}, {"meta": {"severity": "low"}}, {"meta": {}}])
def test_what_a_suite_file_means_is_never_guessed(change):
    rule = {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "x", "min_value": 0},
            "meta": {"severity": "HIGH"}}
    assert Q.suite_of({"expectation_suite_name": "s", "expectations": [rule]})[1] == [("between", "x", (0, None), "HIGH")]
    with pytest.raises(ValueError, match="suite s"):
        Q.suite_of({"expectation_suite_name": "s", "expectations": [rule | change]})


def test_suites_need_their_table_and_columns(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="no table"):
        Q.expectations_report({}, {"s": [("not_null", "x", None, "HIGH")]})
    with pytest.raises(ValueError, match="no column"):
        Q.run_suite("s", df, [("not_null", "y", None, "HIGH")])


def test_failing_rows_of_a_hot_rule_are_limited_before_the_shuffle(spark):
    df = spark.range(100_000).select("id", F.lit(None).cast("string").alias("x"))
    out = Q.failing_rows("s", df, ["id"], 7, [("not_null", "x", None, "HIGH")])
    assert [r.id for r in out.orderBy("sample_rank").collect()] == list(range(7))
    assert "WindowGroupLimit" in plan_of(out)
