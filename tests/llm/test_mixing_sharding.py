import hashlib
import math
import re
from collections import Counter, defaultdict

from reelmart.llm import mixing, sharding

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def brute_mix(rows):
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = Counter()
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped, share = {}, 1.5 * sum(total.values())
    while True:
        rest = [s for s in names if s not in capped]
        level = (share - sum(capped.values())) / max(1e-9, sum(weight[s] for s in rest)) if rest else 0
        over = [s for s in rest if level * weight[s] > 2 * total[s]]
        if not over:
            break
        capped |= {s: 2.0 * total[s] for s in over}
    target = {s: capped.get(s, level * weight[s]) for s in names}

    def key(doc_id, text):
        u = (int(hashlib.md5(str("" if doc_id is None else doc_id).encode()).hexdigest()[:13], 16) + .5) / 2 ** 52
        signs = len(re.findall(r"[!-@\[-`{-~]", text or ""))
        return -math.log(u) / (1.0 if text is None else max(.05, 1 - 2 * signs / max(1, len(text))))

    out = []
    for s in names:
        own = defaultdict(list)
        for i, (d, t, x) in enumerate(rows):
            if x == s:
                own[key(d, t), -1 if d is None else d].append(i)
        epochs = math.floor(target[s] / total[s]) if total[s] else 0
        left, upto = target[s] - epochs * total[s], 0
        for k in sorted(own):
            n = sum(size[i] for i in own[k])
            upto += n
            for i in own[k]:
                out.append((rows[i][0], size[i], total[s], round(target[s], 6),
                            size[i] * (epochs + (upto - n / 2 <= left))))
    return sorted(out, key=repr)


def test_mix_equals_brute_force(odd, small):
    for frame in (odd, small):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in frame.select("doc_id", "text", "source").collect()]
        got = mixing.mix(frame)
        assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
        assert sorted(((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in got.collect()), key=repr) == brute_mix(rows)


def test_mix_whatever_the_buckets(small, monkeypatch):
    want = sorted(map(tuple, mixing.mix(small).collect()))
    monkeypatch.setattr(mixing, "plan_buckets", lambda docs: 7)
    assert sorted(map(tuple, mixing.mix(small).collect())) == want


def test_mixed_rows_repeat_as_taken(odd):
    rows = mixing.mixed_rows(odd)
    assert rows.schema == odd.schema
    got = Counter((r["doc_id"], r["text"]) for r in rows.collect())
    want = Counter()
    text = {(r["doc_id"], mix): r["text"] for r in odd.collect() for mix in [0]}
    for r in mixing.mix(odd).collect():
        if r["size"]:
            want[r["doc_id"], text[r["doc_id"], 0]] += r["taken"] // r["size"]
    assert {k: v for k, v in got.items() if WORD.search(k[1] or "")} == {k: v for k, v in want.items() if v}


def test_empty(empty):
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0
    assert sharding.shard(empty).count() == 0 and sharding.sharded_rows(empty).count() == 0


def checked(rows, parts=8):
    total, shards = sum(r["size"] for r in rows), defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r)
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    most = max(r["size"] for r in rows)
    for s in range(parts):
        assert abs(sum(r["size"] for r in shards[s]) - total / parts) <= most + 0.03 * total / parts
    return shards


def test_shards_are_even_and_gapless(small):
    rows = sharding.shard(small).collect()
    checked(rows)
    assert len(rows) == small.count()
    import zlib
    text = {r["doc_id"]: r["text"] for r in small.collect()}
    assert all(r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode())
               and r["size"] == len((text[r["doc_id"]] or "").encode()) + 1 for r in rows)


def test_hot_group_is_divided_and_small_groups_are_not(spark):
    rows = [(i, "hot text " * 20) for i in range(1000)]
    rows += [(1000 + i, f"text {i // 2} " * 15) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sharding.shard(docs).collect()
    checked(got)
    where = defaultdict(set)
    for r in got:
        where[rows[r["doc_id"]][1]].add(r["shard"])
    assert len(where["hot text " * 20]) > 1
    assert all(len(s) == 1 for t, s in where.items() if not t.startswith("hot"))


def test_sharded_rows_agree_with_shard(odd):
    got = Counter((r["doc_id"], r["shard"]) for r in sharding.sharded_rows(odd).collect())
    assert got == Counter((r["doc_id"], r["shard"]) for r in sharding.shard(odd).collect())
