"""Filter interaction audit by truth-table survival words.

Five filters fail a document or not. Its five failures pick one 32-bit word:
bit S (S a subset of the filters) is set if the document survives all filters
of S. Carry-save adders sum the words of a part bit by bit, for all documents,
for the good and for the toxic ones; 32 sums a part and label answer every
question about every order of the filters: what a step removes is a difference
of two of them.

The texts are mapped to narrow rows once (stored in the shared folder). Copies
are found by a hash aggregate over 128-bit text hashes and joined back by hash;
words are summed inside each Arrow batch first, then by partial aggregates, so
a part that holds most documents is a few rows a task. Nothing grows with the
documents but the narrow rows.

Defined cases: a null text is an empty one (no words, no characters); an empty
table gives no rows. Failure E compares doc_ids as numbers: a null doc_id is
neither smaller nor larger than another, equal rows under one doc_id are no
copies of one another (ties keep both). Repeated rows count as often as they
stand there. A null ``source`` is the part '', together with an empty one.
Several labels of one doc_id count as good (toxic) if one of them is 1; labels
without doc_id are ignored. Very long texts are read whole, a few at a time.
Other columns, also of clashing names, are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import slices, stored

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
#: UTF-8 bytes that begin no character
CONTINUED = bytes(range(0x80, 0xC0))
SUBSETS = 1 << len(FILTERS)
FULL = SUBSETS - 1
#: truth table: failures (a bit a filter) -> word of the subsets survived
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & fails) for fails in range(SUBSETS)],
                 np.uint32)
#: labels whose survivors are summed: all documents, good ones, toxic ones
SUMS = ["n", "good", "toxic"]


def text_failures(data: bytes) -> int:
    """Failures A to D of a whole UTF-8 text, as bits."""
    words = data.split()  # at space, tab, LF, VT, FF, CR
    points = len(data.translate(None, CONTINUED))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > CAPITAL_PERCENT * points) << 2
            | (len(data.translate(None, SYMBOLS)) < len(data)) << 3)


def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
        marks = np.frombuffer(b"".join(hashlib.md5(t).digest() for t in texts), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"),
             pa.array([text_failures(t) for t in texts], pa.int32()),
             pa.array(marks[:, 0].copy()), pa.array(marks[:, 1].copy())],
            ["doc_id", "part", "fails", "h1", "h2"])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (bits of A to E), good and toxic of every document."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = stored(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text").mapInArrow(
        narrow, f"doc_id {kind}, part string, fails int, h1 long, h2 long"), "failures")
    # stored, so that both sides of the join come by plain exchanges and Spark may split a hot text
    first = stored(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").drop("n"), "copies")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return (rows.join(first, ["h1", "h2"], "left").join(marks, "doc_id", "left")
            .select("part", (F.col("fails") + 16 * copy).alias("fails"),
                    F.coalesce("good", F.lit(False)).alias("good"),
                    F.coalesce("toxic", F.lit(False)).alias("toxic")))


def bit_sums(words: np.ndarray) -> np.ndarray:
    """How many words have each of the 32 bits: carry-save adders take three
    words to a sum and a carry of twice the weight until at most two are left
    of each weight."""
    total, weight = np.zeros(32, np.int64), 1
    place = np.arange(32, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) >= 3:
            m = len(words) // 3
            x, y, z = words[:m], words[m:2 * m], words[2 * m:3 * m]
            odd = x ^ y
            carries.append((x & y) | (odd & z))
            words = np.concatenate([odd ^ z, words[3 * m:]])
        total += weight * ((words[:, None] >> place) & np.uint32(1)).sum(0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return total


def part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Survivors of each subset, for the parts of an Arrow batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, parts = pd.factorize(np.array(batch.column("part").to_pylist(), object))
        order = np.argsort(codes, kind="stable")
        words = WORDS[batch.column("fails").to_numpy()][order]
        chosen = [np.ones(len(words), bool)] + [
            batch.column(c).to_numpy(zero_copy_only=False)[order] for c in SUMS[1:]]
        edges = np.append(np.flatnonzero(np.diff(codes[order], prepend=-1)), len(words))
        sums = [[bit_sums(words[a:b][keep[a:b]]) for a, b in itertools.pairwise(edges)] for keep in chosen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts.tolist(), pa.string()),
             *[pa.array(column) for rows in sums for column in np.array(rows).T.copy()]],
            ["part", *COLUMNS])


COLUMNS = [f"{name}{s}" for name in SUMS for s in range(SUBSETS)]


def survivors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part and the survivors of each subset S of the filters: n<S>, good<S>, toxic<S>."""
    partial = failures(docs, labels).mapInArrow(
        part_sums, "part string, " + ", ".join(f"{c} long" for c in COLUMNS))
    return partial.groupBy("part").agg(*[F.sum(c).alias(c) for c in COLUMNS])


ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]


def reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The 600 rows of each part, from its 96 sums."""
    steps = [(o, i + 1, sum(1 << FILTERS.index(c) for c in o[:i]), FILTERS.index(f))
             for o in ORDERS for i, f in enumerate(o)]
    names, step, before, which = (np.array(x) for x in zip(*steps))
    bit = 1 << which
    after = before | bit
    # orders in which just the filters of s stand before f
    share = [{s: math.factorial(s.bit_count()) * math.factorial(len(FILTERS) - 1 - s.bit_count())
              for s in range(SUBSETS) if not s >> f & 1} for f in range(len(FILTERS))]
    for frame in frames:
        for part, *sums in frame[["part", *COLUMNS]].itertuples(index=False):
            n, good, toxic = np.array(sums, np.int64).reshape(len(SUMS), SUBSETS)
            removed = n[before] - n[after]
            shapley = np.array([sum(w * (n[s] - n[s | 1 << f]) for s, w in share[f].items())
                                for f in range(len(FILTERS))])
            yield pd.DataFrame({
                "part": part, "filter_order": names, "step": step, "kept": n[after], "removed": removed,
                "redundant": n[0] - n[bit] - removed, "unique_fails": n[FULL ^ bit] - n[FULL],
                "good_lost": good[before] - good[after], "toxic_lost": toxic[before] - toxic[after],
                "shapley": shapley[which]})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order of the filters and step, zeros included."""
    return survivors(docs, labels).mapInPandas(
        reports, "part string, filter_order string, step int, kept long, removed long, redundant long,"
        " unique_fails long, good_lost long, toxic_lost long, shapley long")
