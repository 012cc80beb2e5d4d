"""N-gram Jaccard join by chosen paths.

A text is its set of word 5-grams. Sets are embedded as ``COORDINATES`` minhash
tokens, one a coordinate. A run splits all sets recursively: each node samples
1 / ``SIMILARITY`` of a coordinate on average, one at least, and a child is the
sets that share the token there; similar sets stay together on some path.
Buckets of at most ``BUCKET`` sets, and those at the last depth, are compared
by brute force on the tokens. Runs are repeated until the target recall.

What the buckets tie together is then verified exactly, on the sets of 5-grams
of the whole texts: all pairs inside a tied component, in blocks of at most
``BLOCK`` sets against ``BLOCK`` sets, so that a group of any size is spread
over tasks. Blocks give counts of links and a spanning forest, never pairs.

Equal sets are merged first and counted; classes are connected components of
links at ``SIMILARITY`` or more.

Defined cases: null, empty and blank texts have no 5-grams, no link, and are a
class each; a text of 1 to 4 words is one n-gram of all its words; copies are
linked to each other; a null doc_id stays null, and a class of null ids only
has a null class_id; repeated rows are links too, and of rows alike in doc_id
and text ``one_of_each`` keeps one; a class is named by its least doc_id, so
ties don't matter; very long texts give all their 5-grams; an empty table gives an empty result; other
columns are not looked at (``one_of_each`` carries them through).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import bounds_of, cut, forest, maybe_broadcast, runs, slices, text_key
from reelmart.llm.graph import components

GRAM = 5
SIMILARITY = 0.8
COORDINATES = 128
DEPTH = 3
BUCKET = 64
RECALL = 0.995
#: tokens agreeing in a bucket, at least, for a tie: 4 deviations below SIMILARITY
TIE = 0.65
BLOCK = 512
#: narrow rows that may be broadcast
MOST_ROWS = 500_000
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD1342543DE82EF95)


def survival(similarity: float = SIMILARITY, depth: int = DEPTH) -> float:
    """Chance that a pair at the threshold still shares a bucket at ``depth``."""
    second = 1 / SIMILARITY - 1  # chance that a node samples a second coordinate
    s = 1.0
    for _ in range(depth):
        miss = 1 - similarity * s
        s = 1 - (1 - second) * miss - second * miss ** 2
    return s


def runs_for(recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival()))


# texts to sets ----------------------------------------------------------------
def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * BASE
    return x ^ (x >> np.uint64(32))


def gram_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the distinct n-grams of each text, sorted."""
    words = [t.encode("utf-8", "replace").split() if t else [] for t in texts]
    flat = [w for ws in words for w in ws]
    if not flat:
        return [np.zeros(0, np.uint64) for _ in texts]
    at, unique = pd.factorize(np.array([*flat, None], object)[:-1])
    h = pd.util.hash_array(unique, categorize=False).astype(np.uint64)[at]
    roll = np.zeros(len(h), np.uint64)
    for k in range(GRAM):
        roll[:max(0, len(h) - k)] = roll[:max(0, len(h) - k)] * BASE + h[k:]
    # the first GRAM - 1 steps above lack words near the end; whole n-grams only are used
    roll = mixed(roll)
    out, begin = [], 0
    for ws in words:
        n = len(ws)
        if n >= GRAM:
            out.append(np.unique(roll[begin:begin + n - GRAM + 1]))
        elif n:
            whole = np.uint64(n)
            for x in h[begin:begin + n]:
                whole = np.uint64((int(whole) * int(BASE) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mixed(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
        begin += n
    return out


def multipliers() -> np.ndarray:
    return np.random.default_rng(715).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, th, fp (fingerprint of the set; null if empty), tokens."""
    times = multipliers()
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        for a in range(0, len(texts), 200):
            sets = gram_sets(texts[a:a + 200])
            tokens = np.zeros((len(sets), COORDINATES), np.int32)
            prints: list[int | None] = []
            for i, s in enumerate(sets):
                if not len(s):
                    prints.append(None)
                    continue
                low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
                for b in range(0, len(s), 1024):
                    low = np.minimum(low, (s[b:b + 1024, None] * times).min(axis=0))
                tokens[i] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
                total = mixed(np.array([mixed(s).sum() + np.uint64(len(s))], np.uint64))
                prints.append(int(total.view(np.int64)[0]))
            flat = pa.array(tokens.ravel())
            offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES)
            part = batch.slice(a, len(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array(prints, pa.int64()),
                 pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "th", "fp", "tokens"])


# chosen paths -----------------------------------------------------------------
def children() -> Column:
    """The paths on which a set goes on from its node (columns path, tokens)."""
    def child(slot: int) -> Column:
        at = F.pmod(F.xxhash64("path", F.lit(slot)), F.lit(COORDINATES)).cast("int")
        return F.xxhash64("path", F.lit(slot), F.element_at("tokens", at + 1))

    second = F.pmod(F.xxhash64("path", F.lit(99)), F.lit(10_000)) < int(10_000 * (1 / SIMILARITY - 1))
    return F.explode(F.when(second, F.array(child(1), child(2))).otherwise(F.array(child(1))))


def sized(nodes: DataFrame) -> DataFrame:
    """Rows of (path, fp) in buckets of two or more, with the bucket's size. The
    sizes are stored first, so that Spark may split a large bucket's side."""
    n = cut(nodes.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"))
    return cut(nodes.join(n, "path"))


def buckets(sets: DataFrame, recall: float = RECALL) -> DataFrame:
    """(path, n, fp): the rows of all leaf buckets of all runs."""
    roots = F.array(*[F.lit(7_000_003 * (r + 1)).cast("long") for r in range(runs_for(recall))])
    nodes = sets.select("fp", "tokens", F.explode(roots).alias("path"))
    leaves = None
    for depth in range(1, DEPTH + 1):
        level = sized(nodes.select("fp", children().alias("path")).distinct())
        leaf = level if depth == DEPTH else level.where(F.col("n") <= BUCKET)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        if depth < DEPTH:
            nodes = level.where(F.col("n") > BUCKET).join(sets.select("fp", "tokens"), "fp")
    return leaves


def in_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows of groups (``key``, size ``n``) dealt to pairs of blocks: columns bi, bj,
    and own, the block of the row. Each pair of rows meets in one pair of blocks."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(5)), blocks).cast("int")
    return (rows.withColumn("own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("bi", F.least("own", "_other")).withColumn("bj", F.greatest("own", "_other"))
            .drop("_other", "n").repartition(key, "bi", "bj").sortWithinPartitions(key, "bi", "bj"))


def tied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ties (a, b) of bucket members to their component's first member."""
    keys = ["path", "bi", "bj"]
    for frame in runs(frames, keys):
        cuts = bounds_of(frame, keys)
        tokens = np.stack(frame["tokens"].to_numpy()).astype(np.int32)
        fp = frame["fp"].to_numpy()
        a, b = [], []
        for low, high in zip(cuts[:-1], cuts[1:]):
            own, n = tokens[low:high], high - low
            left, right = [], []
            for i in range(0, n, 16):
                near = (own[i:i + 16, None, :] == own[None, :, :]).sum(axis=2) >= TIE * COORDINATES
                x, y = np.nonzero(near)
                left.append(x + i)
                right.append(y)
            root = forest(n, np.concatenate(left), np.concatenate(right))
            child = np.flatnonzero(root != np.arange(n))
            a.append(fp[low:high][child])
            b.append(fp[low:high][root[child]])
        yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})


# verification -----------------------------------------------------------------
def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    df = np.bincount(column)
    out = np.full((n, n), float((df == n).sum()), np.float32)
    some = (df > 1) & (df < n)
    number = np.cumsum(some) - 1
    keep = some[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for low in range(0, int(some.sum()), width):
        i, j = np.searchsorted(column, (low, low + width))
        x = np.zeros((n, width), np.float32)
        x[owner[i:j], column[i:j] - low] = 1
        out += x @ x.T
    return out


def verified(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(fp, links, root): links to other sets, copies counted, in a pair of blocks."""
    keys = ["comp", "bi", "bj"]
    for frame in runs(frames, keys):
        out = []
        for low, high in zip((cuts := bounds_of(frame, keys))[:-1], cuts[1:]):
            own = frame.iloc[low:high].drop_duplicates("fp")
            if len(own) < 2:
                continue
            sets = gram_sets(list(own["text"]))
            size = np.array([len(s) for s in sets], np.float32)
            both = shared_counts(sets)
            link = both >= SIMILARITY * (size[:, None] + size[None, :] - both) - 1e-3
            np.fill_diagonal(link, False)
            if own["bi"].iloc[0] != own["bj"].iloc[0]:  # pairs across the blocks only
                block = own["own"].to_numpy()
                link &= block[:, None] != block[None, :]
            root = forest(len(own), *np.nonzero(link))
            hit = link.any(axis=1)
            fp = own["fp"].to_numpy()
            links = link @ own["m"].to_numpy(np.int64)
            out.append(pd.DataFrame({"fp": fp[hit], "links": links[hit], "root": fp[root[hit]]}))
        if out:
            yield pd.concat(out)


def classes(docs: DataFrame, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, fp) of every row, and of each set (fp) its first row (rep),
    its class's first row (first) and its links."""
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", text_key().alias("th"), "text")
    rows = cut(texts.mapInArrow(sketched, f"doc_id {kind}, th long, fp long, tokens array<int>"))
    sets = cut(rows.where("fp is not null").groupBy("fp").agg(
        F.count("*").alias("m"), F.first("tokens").alias("tokens"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("rep")))
    leaves = buckets(sets, recall).join(sets.select("fp", "tokens"), "fp")
    ties = in_blocks(leaves, "path").mapInPandas(tied, "a long, b long")
    comps = components(ties).select(F.col("node").alias("fp"), F.col("root").alias("comp"))
    n = comps.groupBy("comp").agg(F.count("*").alias("n"))
    members = cut(comps.join(n, "comp").join(sets.drop("tokens"), "fp").select(
        "fp", "comp", "n", "m", F.col("rep.doc_id").alias("_id"), F.col("rep.th").alias("_th")))
    few = maybe_broadcast(members, members.count(), MOST_ROWS)
    held = texts.join(few, texts["doc_id"].eqNullSafe(few["_id"]) & (texts["th"] == few["_th"]))
    checked = cut(in_blocks(held.select("fp", "comp", "n", "m", "text"), "comp").mapInPandas(
        verified, "fp long, links long, root long"))
    roots = components(checked.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("fp").agg(F.sum("links").alias("links"))
    known = (sets.drop("tokens").join(links, "fp", "left")
             .join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    first = known.groupBy("root").agg(F.min("rep").alias("first"))
    info = known.join(first, "root").select(
        "fp", "m", "rep", "first", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return rows.drop("tokens"), cut(info)


def jaccard_join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links): the smallest doc_id of each row's class, and
    how many other rows its text is linked to."""
    rows, info = classes(docs, recall)
    return rows.join(info, "fp", "left").select(
        "doc_id", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(
            F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns, that are first in their class."""
    rows, info = classes(docs, recall)
    alike = rows.groupBy("doc_id", "th", "fp").agg(F.count("*").alias("n"))
    stays = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.th") == F.col("th"))
    odd = cut(alike.where("fp is not null").join(info, "fp").withColumn("_stays", stays)
              .where("not _stays or n > 1")
              .select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "_stays"))
    odd = maybe_broadcast(odd, odd.count(), MOST_ROWS)
    keyed = docs.join(odd, docs["doc_id"].eqNullSafe(odd["_id"]) & (text_key() == odd["_th"]), "left")
    once = (keyed.where("_stays").groupBy("_id", "_th")
            .agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias("_row")).select("_row.*"))
    return keyed.where("_stays is null").select(*docs.columns).unionByName(once)
