import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from reelmart.llm import decontaminate, jaccard, kneser_ney, registry
from reelmart.llm.graph import components
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


# Kneser-Ney -------------------------------------------------------------------
def brute_log_ppl(train, texts, order=kneser_ney.ORDER):
    def grams(t, n):
        s = "\x02" * (order - 1) + t + "\x03"
        return [s[i - n + 1:i + 1] for i in range(order - 1, len(s))]

    count = {order: collections.Counter(g for t in train for g in grams(t, order))}
    for n in range(order - 1, 0, -1):
        count[n] = collections.Counter(g[1:] for g in count[n + 1])
    law = {}
    for n in count:
        of = collections.Counter(count[n].values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + of[2] else 0
        law[n] = [max(0.05, min(i - 0.05, i - (i + 1) * y * of[i + 1] / of[i] if of[i] else i / 2)) for i in (1, 2, 3)]
    ctx = collections.defaultdict(list)
    for n in count:
        for g, c in count[n].items():
            ctx[n, g[:-1]].append(c)

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / 4096
        lower = p(g[1:])
        own = ctx.get((n, g[:-1]))
        if not own:
            return lower
        d = law[n]
        back = sum(d[min(c, 3) - 1] for c in own) / sum(own) * lower
        c = count[n].get(g, 0)
        return back + ((c - d[min(c, 3) - 1]) / sum(own) if c else 0)

    return [-sum(math.log(p(g)) for g in grams(t, order)) / (len(t) + 1) for t in texts]


def test_scores_equal_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"][:300], "l1" if i % 2 else "l2") for i, r in enumerate(
        small.orderBy("doc_id").limit(60).collect())]
    rows += [(700, None, "l1"), (701, "", "l1"), (702, "never seen ☃漢", "l1"), (703, "no model", "l3"),
             (704, "no language", None), (None, "no id", "l1")]
    docs = spark.createDataFrame([(*r, 0.5, 3) for r in rows], "doc_id long, text string, lang string, p double, fold int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(3, 0, 0), (4, 1, 1), (None, 1, 0), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    fold = {r["_id"]: r["fold"] for r in kneser_ney.trusted_ids(labels).collect()}
    assert 3 not in fold and 4 not in fold and fold[5] in (0, 1)
    got = {r["doc_id"]: r for r in kneser_ney.scores(docs.repartition(4), labels).collect()}
    assert len(got) == len(rows)
    for lang in ("l1", "l2"):
        own = [r for r in rows if r[2] == lang]
        want = brute_log_ppl([r[1] for r in own if fold.get(r[0]) == 0], [r[1] or "" for r in own])
        for r, w in zip(own, want):
            assert got[r[0]]["log_ppl"] == pytest.approx(w, rel=1e-5), r[0]
    assert got[703]["log_ppl"] is None and got[704]["log_ppl"] is None and got[704]["lang"] == "und"
    judged = {r["doc_id"]: r["kept"] for r in kneser_ney.judge(docs, labels).collect()}
    assert judged[703] and judged[704]


def test_quality_cases(spark, odd, empty):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = kneser_ney.judge(odd, labels)
    assert rows.count() == odd.count()
    kept = kneser_ney.good_rows(odd, labels)
    assert kept.columns == odd.columns
    assert kept.count() == rows.where("kept").count()
    assert kneser_ney.judge(empty, labels).count() == 0
    assert kneser_ney.judge(odd, labels.limit(0)).where("not kept").count() == 0


def test_word_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "WORD_BITS", 12)
    monkeypatch.setattr(kneser_ney, "KINDS", ((kneser_ney.ORDER, kneser_ney.BITS), (2, 12)))
    rng = random.Random(6)
    phrases = [f"w{i}a w{i}b w{i}c w{i}d" for i in range(12)]
    texts = [" ".join(rng.choices(phrases, k=15)) for _ in range(60)]
    shuffled = texts[50].split()
    rng.shuffle(shuffled)
    rows = list(enumerate([*texts, " ".join(shuffled), "", None, "not seen at all", " ".join(["w3a"] * 60)]))
    docs = spark.createDataFrame([(*r, "l1") for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    fold = {r["_id"]: r["fold"] for r in kneser_ney.trusted_ids(labels).collect()}
    letter = collections.defaultdict(lambda: chr(0xE000 + len(letter)))
    as_letters = ["".join(letter[w] for w in (t or "").split()) for _, t in rows]
    want = brute_log_ppl([as_letters[i] for i in range(50) if fold[i] == 0], as_letters, 2)
    got = {r["doc_id"]: r["word_log_ppl"] for r in kneser_ney.scores(docs.repartition(3), labels).collect()}
    assert [got[i] for i, _ in rows] == [pytest.approx(w, rel=1e-5) for w in want]
    kept = {r["doc_id"]: r["kept"] for r in kneser_ney.judge(docs, labels).collect()}
    assert kept[50] and kept[51] and not kept[60] and not kept[64]


# Jaccard ----------------------------------------------------------------------
def brute_classes(rows):
    """{row number: (class's smallest id, links)}"""
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    first = collections.defaultdict(list)
    for i in range(n):
        first[find(i)].append(rows[i][0])
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in first.items()}
    return sorted(((rows[i][0], low[find(i)], links[i]) for i in range(n)), key=repr)


def near_copies(seed, n, length=60):
    rng = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(length), rng.randrange(2)):
            words[at] = f"e{rng.randrange(10 ** 9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block,bucket", [(512, 64), (7, 4)])
def test_join_equals_brute_force(spark, odd, block, bucket, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    for seed, n in ((1, 30), (2, 2), (3, 5)):
        rows += [(10_000 * seed + i, t) for i, t in enumerate(near_copies(seed, n))]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, path int")
    got = sorted((tuple(r) for r in jaccard.jaccard_join(docs).collect()), key=repr)
    assert got == brute_classes(rows)


def test_one_of_each(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = {(c if c is not None else d) for d, c, _ in brute_classes(rows)}
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted(want, key=repr)
    assert jaccard.jaccard_join(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0


def test_target_recall_at_the_threshold():
    """Pairs at similarity 0.8 meet in a bucket of some run as often as asked."""
    assert 1 - (1 - jaccard.survival()) ** jaccard.runs_for() >= jaccard.RECALL


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for pair in links for x in pair if pair[0] != pair[1]}


# registered queries and the pipeline -------------------------------------------
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF_SMALL), name, registry.QUERIES[name], registry.ORACLE[name], SF_SMALL)


def test_pipeline(spark, small):
    docs = small
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = collections.Counter(r["doc_id"] for r in docs.collect())
        after = stage(spark, docs, SF_SMALL)
        if name != "sharding":
            assert after.columns == small.columns
        rows = collections.Counter(r["doc_id"] for r in after.collect())
        assert set(rows) <= set(before)
        text = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality":
            labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
            good = [i for i in before if i in labels and labels[i]["quality"] == 1]
            assert sum(i in rows for i in good) / len(good) >= 0.9
        elif name == "near duplicates":
            assert set(rows) == {c for _, c, _ in brute_classes(sorted(text.items()))} and max(rows.values()) == 1
        elif name == "decontamination":
            items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            for i, t in text.items():
                words = b" ".join(decontaminate.words_of(t))
                if any(b" ".join(x) in words for x in items if len(x) >= 5):
                    assert i not in rows
        elif name == "mixing":
            assert max(rows.values()) <= 2
        kept[name] = rows
        docs = spark.createDataFrame(after.collect(), after.schema)
    assert kept["sharding"] == kept["mixing"]
    assert np.ptp(list(collections.Counter(r["shard"] for r in docs.collect()))) == 7
    assert corpus_pipeline.run(spark, SF_SMALL).count() == sum(kept["sharding"].values())


def test_good_rows_know_a_row_by_its_language_too(spark, monkeypatch):
    """One id and text under two languages: what is rejected under one stays under the other."""
    from pyspark.sql import functions as F

    from reelmart.llm.common import text_key
    docs = spark.createDataFrame([(1, "same", "de", 0), (1, "same", "en", 1), (1, "same", None, 2), (1, "other", "de", 3),
                                  (None, None, "de", 4), (2, "same", "de", 5)],
                                 "doc_id long, text string, lang string, row int")
    verdict = docs.select("doc_id", text_key().alias("th"), F.coalesce("lang", F.lit("und")).alias("lang"),
                          (~F.col("row").isin(0, 4)).alias("kept"))
    monkeypatch.setattr(kneser_ney, "judge", lambda docs, labels: verdict)
    assert sorted(r["row"] for r in kneser_ney.good_rows(docs, None).collect()) == [1, 2, 3, 5]


def test_the_filter_refuses_no_code_of_the_model(spark):
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 1 << 60, 50_000))
    table = spark.createDataFrame([(int(c),) for c in codes], "code long").repartition(5)
    known = kneser_ney.code_filter(table)
    assert (kneser_ney.maybe_met(known, codes) == codes).all()
    other = np.setdiff1d(rng.integers(0, 1 << 60, 50_000), codes)
    assert len(kneser_ney.maybe_met(known, other)) < 500
    assert not len(kneser_ney.maybe_met(known, codes[:0]))


def test_codes_travel_as_few_bytes():
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, 1 << 48, 200_000))
    counts = rng.integers(1, 4, len(codes))
    shards, blobs = kneser_ney.dealt([codes, counts], 7)
    assert shards == list(range(7)) and sum(map(len, blobs)) < 5.5 * len(codes)
    back = kneser_ney.summed(kneser_ney.joined(blobs + blobs, 2))
    assert (back[0] == codes).all() and (back[1] == 2 * counts).all()
    assert kneser_ney.dealt([codes[:0]], 7) == ([], [])


def test_word_and_character_grams_by_hand():
    texts = ["", " ", "a bc d\n", "漢字x y\x00 y", "a bc"]
    keys, n = kneser_ney.word_codes_of(texts)
    assert n.tolist() == [1, 1, 4, 6, 3]
    ends = np.cumsum(n)
    one = {t: kneser_ney.word_codes_of([t])[0].tolist() for t in texts}
    assert [keys[e - k:e].tolist() for e, k in zip(ends, n)] == [one[t] for t in texts]
    assert keys[-3] == keys[2] and keys[-2] == keys[3] and len(set(one["漢字x y\x00 y"])) == 6
    at, distinct, n = kneser_ney.grams(texts, 0, kneser_ney.BITS)
    assert n.tolist() == [len(t) + 1 for t in texts] and len(set(distinct.tolist())) == len(distinct)
    for t, part in zip(texts, np.split(distinct[at], np.cumsum(n)[:-1])):
        c = [2] * 3 + [ord(x) if ord(x) < 3072 else 3072 + ord(x) % 1024 for x in t] + [3]
        assert part.tolist() == [sum(x << 12 * (3 - j) for j, x in enumerate(c[i:i + 4])) for i in range(len(c) - 3)]


@pytest.mark.parametrize("few", [100_000, 0])
def test_few_links_go_to_few_tasks(spark, monkeypatch, few):
    """Before, each round dealt even a few links to all shuffle partitions."""
    from reelmart.llm import graph
    monkeypatch.setattr(graph, "FEW_LINKS", few)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        links = [(i, i + 1) for i in range(20)] + [(50, 60), (60, 55), (7, 7), (None, 3), (50, 60)]
        got = components(spark.createDataFrame(links, "a long, b long").repartition(3))
        assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(21)] + [(50, 50), (55, 50), (60, 50)]
        assert (got.rdd.getNumPartitions() <= graph.FEW_TASKS) == (few > 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_answers_come_back_in_the_order_of_the_request_without_codes():
    """Before, each answer held its codes again: over 4 bytes a code."""
    rng = np.random.default_rng(6)
    keys = np.unique(rng.integers(0, 1 << 48, 60_000))
    codes = np.sort(np.concatenate([kneser_ney.tagged(3, 2, keys, 24), kneser_ney.tagged(3, 1, keys[::50] >> 24, 24)]))
    some = rng.random(len(codes)) < 0.7
    model = [codes[some], rng.integers(1, 3, some.sum()), *[rng.integers(0, 2, some.sum()) for _ in range(4)]]
    parts, requests = kneser_ney.dealt(model, 5), kneser_ney.dealt([codes], 5)
    answers = pa.concat_tables([kneser_ney.answer(
        pa.table({"batch": pa.array([0], pa.int32()), "shard": pa.array([s], pa.int32()), "blob": [blob]}),
        pa.table({"shard": [s], "blob": [parts[1][s]]})) for s, blob in zip(*requests)])
    assert parts[0] == requests[0] == list(range(5))
    assert sum(len(b.as_py()) for b in answers.column("blob")) < 2 * len(codes)
    got = kneser_ney.Answers(codes, answers, 5, {})
    assert (got.c[some] == model[1]).all() and not got.c[~some].any()
    assert (got.sums[:, some] == np.stack(model[2:])).all() and not got.sums[:, ~some].any()
    absent = kneser_ney.answer(answers.slice(0, 0), pa.table({"shard": [0], "blob": [parts[1][0]]}))
    assert not len(absent) and absent.column_names == answers.column_names
    assert not kneser_ney.Answers(codes, absent, 5, {}).c.any()


def test_codes_are_scattered_and_taken_back():
    kinds = kneser_ney.KINDS
    for kind, (order, bits) in enumerate(kinds):
        for length in range(order + 1):
            keys = np.unique(np.arange(500) * 7919 % (1 << bits * length))
            codes = kneser_ney.tagged(kneser_ney.number(5, kind), length, keys, bits)
            assert len(set(codes.tolist())) == len(keys)
            tag, n, b, back = kneser_ney.spread(codes, kinds)
            assert (back == keys).all() and (n == length).all() and (b == bits).all()
            assert (tag == (kneser_ney.number(5, kind) << 3 | length)).all()
    assert kneser_ney.distinct_of(np.array([3, 1, 3, 2, 1])).tolist() == [1, 2, 3]
    assert not len(kneser_ney.distinct_of(np.zeros(0, np.int64)))


def test_a_batch_is_one_language_and_few_characters(monkeypatch):
    """Before, a batch was a whole scan partition, so that memory grew with it."""
    monkeypatch.setattr(kneser_ney, "MOST_TEXT", 5_000)
    monkeypatch.setattr(kneser_ney, "BLOB_BYTES", 1_000)
    langs = {"a": 0, "b": 1}
    rows = [(i, i, "abx"[i % 3], None if i == 5 else "word " * (i % 40), i // 200) for i in range(400)]
    table = pa.table([pa.array(c) for c in zip(*rows)], ["doc_id", "th", "lang", "text", "part"])
    held = {}
    for part in (0, 1):
        mine = table.filter(pa.compute.equal(table["part"], part)).to_batches(max_chunksize=70)
        for packed in kneser_ney.pack(langs)(iter(mine)):
            for at, blob in zip(packed.column("batch").to_pylist(), packed.column("blob").to_pylist()):
                held.setdefault(at, []).extend(pa.ipc.open_stream(blob).read_all().to_pylist())
    assert sorted(r["doc_id"] for own in held.values() for r in own) == list(range(400))
    for own in held.values():
        assert len({r["lang"] for r in own}) == 1 and len({r["doc_id"] // 200 for r in own}) == 1
        assert sum(len(r["text"] or "") for r in own) < 7_000
    assert len(held) > 6


def test_a_language_has_a_range_of_the_shards():
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 1 << 48, 30_000))
    codes = np.concatenate([kneser_ney.tagged(kneser_ney.number(lang, 0), 4, keys, 12) for lang in range(4)])
    by = kneser_ney.places_by_shard(codes, kneser_ney.Shares(10, [5, 0, 3, 2]))
    assert sorted(np.concatenate(list(by.values())).tolist()) == list(range(len(codes)))
    met = [{s for s, at in by.items() if (codes[at] >> kneser_ney.UNIT + 4 == lang).any()} for lang in range(4)]
    assert met == [set(range(5)), {5}, {5, 6, 7}, {8, 9}]
    lone = kneser_ney.places_by_shard(codes, kneser_ney.Shares(1, [5, 0, 3, 2]))
    assert list(lone) == [0] and len(lone[0]) == len(codes)


def test_counts_over_four_bytes_are_answered_whole():
    codes = np.sort(kneser_ney.tagged(3, 2, np.arange(100), 24))
    values = [np.arange(100) + (1 << 33), *[np.arange(100)] * 4]
    requests = kneser_ney.dealt([codes], 3)
    parts = dict(zip(*kneser_ney.dealt([codes, *values], 3)))
    answers = pa.concat_tables([kneser_ney.answer(
        pa.table({"batch": [0], "shard": [s], "blob": [blob]}), pa.table({"shard": [s], "blob": [parts[s]]}))
        for s, blob in zip(*requests)])
    got = kneser_ney.Answers(codes, answers, 3, {})
    assert (got.c == values[0]).all() and (got.sums == np.stack(values[1:])).all()
    assert (got.find(codes[::-1], got.c) == values[0][::-1]).all()
