"""Conversation repair, line dedup and filter audit against brute force."""

import collections
import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from reelmart.llm import conversation_repair as cr
from reelmart.llm import filter_audit, line_dedup, oracle, registry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

SPACE = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("key", ["op11_conversations", "op12_lines", "op13_filter_audit"])
def test_equals_duckdb(spark, key):
    assert compare(spark, duck(SF_SMALL), key, registry.QUERIES[key], registry.ORACLE[key], SF_SMALL)


# conversations ------------------------------------------------------------------
def cheapest(rows):
    """rows: (initial, kind). Dijkstra over all edits: least (cost, audit)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, said = heapq.heappop(heap)
        state = said[-1:] if said else ""
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for x in set(legal) & set("ua"):
            heapq.heappush(heap, (cost + 3, audit + "I", i, said + x))
        if i < len(rows):
            initial, kind = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, said))
            if kind != "lost":
                more = 3 * (kind == "cut")
                if initial in legal:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, said + initial))
                for x in set(legal) & set("ua") - {initial}:
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, said + x))
    raise AssertionError


KINDS = {"": cr.SOUND, "lost": cr.LOST, "cut": cr.CUT}


def coded(rows):
    return bytes("suax".find(i) | KINDS[k] << 2 for i, k in rows)


def test_search_equals_dijkstra():
    rng = random.Random(3)
    for n in [*range(8)] * 60 + [15, 16, 17, 33, 40, 64] * 4:
        rows = [(rng.choice("ssuuuaaax"), rng.choice(["", "", "", "cut", "lost"])) for _ in range(n)]
        assert cr.repair(coded(rows)) == cheapest(rows), rows


def test_search_of_a_long_conversation():
    """Work is linear in the rows: 20,000 rows that all need an edit."""
    assert cr.repair(coded([("u", "")] * 20_000)) == (30_000, "KR" * 10_000)


def brute_conversation(rows):
    """rows: (conv_id, turn, role, text) of one conversation."""
    left = []
    for c, turn, role, text in rows:
        spaced = [" " if v is None else str(v) for v in (c, turn, role, text)]
        lot, role, text = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20, *spaced[2:]
        role = "user" if lot == 4 else role
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        left += [(turn, role, text)] * {0: 0, 3: 2}.get(lot, 1)
    left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    kinds, seen = [], set()
    for _, role, text in left:
        kinds.append("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen
                     else "truncated" if text.strip(SPACE)[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in left if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in left]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit = cheapest([(i or "x", {"": "", "truncated": "cut"}.get(k, "lost"))
                            for i, k in zip(initials, kinds)])
    said, state, i = [], "", 0
    for e in audit:
        if e == "I":
            said.append(("assistant" if state == "u" else "user") + ":")
        elif e in "KR":
            role = left[i][1] if e == "K" else "assistant" if state == "u" else "user"
            said.append(role + ":" + left[i][2])
        state = said[-1][0] if said else ""
        i += e != "I"
    return (gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest())


def test_conversations_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.randint(1, 9)):
            turn = rng.choice([t, t, t, t + 2, None, 0, -3])
            role = rng.choice(["user", "assistant", "assistant", "system", "tool", "", None, "üser", "a"])
            text = rng.choice(["Yes.", "No", "Yes.", "Why?\n", "", " \t\x0b", None, "so. so", "ünï 😀", "x" * 9000 + "!"])
            rows += [(c, turn, role, text)] * rng.choice([1, 1, 1, 3])
    rows.append((77, 0, "user", "gone"))  # a conversation that loses all rows
    frame = spark.createDataFrame(
        [(*r, "x", 1, True) for r in rows],
        "conv_id long, turn long, role string, text string, audit string, cost int, head boolean").repartition(5)
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    got = {r[0]: tuple(r)[1:] for r in cr.repaired(frame).collect()}
    assert got == {c: brute_conversation(rs) for c, rs in by.items()}
    assert cr.repaired(frame.limit(0)).count() == 0


def test_conversation_longer_than_a_batch(spark):
    """One conversation over many Arrow batches and segments, its texts streamed."""
    rows = [(1, t, "user" if t % 3 else "assistant", f"text {t % 700}" + "." * (t % 5 > 0)) for t in range(12_000)]
    got = cr.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r)[1:] for r in got] == [brute_conversation(rows)]


def test_string_conversation_ids(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho."), ("b", 5, "assistant", "Hm")]
    got = cr.repaired(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {
        c: brute_conversation([r for r in rows if r[0] == c]) for c in "ab"}


# lines ----------------------------------------------------------------------------
def brute_lines(docs, least=3):
    """docs: (doc_id, text) -> rows of doc_id, n_lines, n_dropped, kept text."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    held = collections.defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add((i is not None, i or 0))
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < least or max(held[key(x)]) == (i is not None, i or 0)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_docs():
    rng = random.Random(5)
    common = [f"Shared line number {i} for many" for i in range(12)]
    docs = []
    for i in range(120):
        lines = [rng.choice(["", "short", f"a line of document {i}: {rng.random()}", *common,
                             "  " + rng.choice(common).upper() + "\t\r", "ÄÖÜ " + common[0], "ÄÖÜ " + common[0].lower()])
                 for _ in range(rng.randint(0, 9))]
        docs.append((i, "\n".join(lines)))
    docs += [(None, common[0]), (None, common[1] + "\n" + common[1]), (7, common[2]), (7, common[2] + "\nmore"),
             (500, None), (501, ""), (502, "\n"), (503, common[3] + "\n" + common[3] + "\n"), (-9, common[4])]
    docs += [docs[3]] * 4 + [(600, "y" * 19), (601, "y" * 19), (602, "y" * 19), (603, "z" * 20), (604, "z" * 20), (605, "z" * 20)]
    docs += [(700 + i, "\n".join(f"wide document line {j % 400} of all" for j in range(3000))) for i in range(3)]
    return docs


@pytest.mark.parametrize("batches,fan", [(4, 2), (1, 2), (7, 2), (5, 3)])
def test_lines_equal_brute_force(spark, batches, fan):
    docs = line_docs()
    frame = spark.createDataFrame([(i, t, 1, 2, "p") for i, t in docs],
                                  "doc_id long, text string, pos int, h1 long, gone string").repartition(5)
    got = line_dedup.dedup(frame, batches=batches, fan=fan).collect()
    assert sorted(map(tuple, got), key=repr) == brute_lines(docs)


def test_lines_of_odd_tables(spark, odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, line_dedup.dedup(odd).collect()), key=repr) == brute_lines(docs)
    assert line_dedup.dedup(empty).count() == 0
    nulls = spark.createDataFrame([(None, "one line that is long enough"), (None, None)], "doc_id long, text string")
    assert sorted(r["n_dropped"] for r in line_dedup.dedup(nulls, min_docs=1).collect()) == [0, 0]


def test_runs_are_levelled(spark):
    """Runs are sorted, levels compacted, and a key's first batch is its holder."""
    import tempfile
    runs = line_dedup.Runs(tempfile.mkdtemp(prefix="runs-"), fan=3)
    for b in range(10):
        runs.add(spark.createDataFrame([(k, 0, 1, 100 - b) for k in range(b, b + 5)],
                                       "h1 long, h2 long, n long, holder long"))
        assert all(len(level) < 3 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    got = {r["h1"]: (r["n"], r["holder"]) for r in line_dedup.merge(runs.all()).collect()}
    first = {k: min(b for b in range(10) if b <= k < b + 5) for k in range(14)}
    assert got == {k: (sum(b <= k < b + 5 for b in range(10)), 100 - first[k]) for k in range(14)}
    for level in runs.levels:
        for run in level:
            for part in run.rdd.glom().collect():
                assert [r["h1"] for r in part] == sorted(r["h1"] for r in part)


# filters --------------------------------------------------------------------------
def brute_audit(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    fails = []
    for i, text, source in docs:
        text = text or ""
        words = [w for w in re.split("[\\x20\\x09-\\x0D]+", text) if w]
        failed = ("A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
                  + "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
                  + "D" * any(c in text for c in "#$%&*|")
                  + "E" * (i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in docs)))
        marks = [r for r in labels if r[0] is not None and r[0] == i]
        fails.append((source or "", failed, any(r[1] == 1 for r in marks), any(r[2] == 1 for r in marks)))
    out = []
    for part in {f[0] for f in fails}:
        own = [f[1:] for f in fails if f[0] == part]
        total = collections.Counter()
        rows = []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                total[f] += len(gone)
                rows.append((part, order, step, len(left), len(gone), sum(f in d[0] for d in own) - len(gone),
                             sum(d[0] == f for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone), f))
        out += [(*r[:-1], total[r[-1]]) for r in rows]
    return sorted(out)


def audit_rows(rng):
    words = [f"w{i}" for i in range(300)] + ["Ünï", "A", "BB", "😀"]
    docs = []
    for i in range(150):
        n = rng.choice([0, 3, 199, 200, 201, 260, 400])
        text = " ".join(rng.choice(words[:rng.choice([20, 100, 304])]) for _ in range(n))
        text += rng.choice(["", "", "#", " |", "\n\x0b\t"])
        docs.append((i, rng.choice([text, text, docs[-1][1] if docs else text]), rng.choice(["p", "q", "", None])))
    docs += [(None, docs[5][1], "p"), (None, None, "q"), (900, None, "p"), (901, "", None), (3, docs[3][1], "p")]
    docs += [(902, "b " * 30_000 + "END", "only")] * 3
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)]
    return docs, labels + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (99_999, 1, 1)]


def test_audit_equals_brute_force(spark):
    docs, labels = audit_rows(random.Random(2))
    frame = spark.createDataFrame([(*d, 5, "x", True, 7) for d in docs], "doc_id long, text string, source string,"
                                  " fails int, part string, good boolean, h1 long").repartition(6)
    marks = spark.createDataFrame([(*r, "z", 1) for r in labels],
                                  "doc_id long, quality int, toxic int, part string, good int")
    got = filter_audit.audit(frame, marks)
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    none = sorted(map(tuple, filter_audit.audit(frame, marks.limit(0)).select("good_lost", "toxic_lost").distinct().collect()))
    assert none == [(0, 0)]


def test_bit_sums():
    rng = np.random.default_rng(1)
    for n in [*range(12), 1000, 4099]:
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert filter_audit.bit_sums(words).tolist() == [int(((words >> b) & 1).sum()) for b in range(32)]


def test_truth_table():
    for fails in range(32):
        for s in range(32):
            assert bool(int(filter_audit.WORDS[fails]) >> s & 1) == (fails & s == 0)
    assert oracle.OP13.count("CASE WHEN") == len(filter_audit.FILTERS)
