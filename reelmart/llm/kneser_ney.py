"""Quality classifier: interpolated modified Kneser-Ney over characters and words.

For each language, a character model of order ``ORDER`` and a word model of
order ``WORD_ORDER`` are trained on trusted text (labelled quality 1 and not
toxic, half of it); the other half calibrates: a document goes if its
perplexity per character or per word lies above its language's quantile there
by more than a margin. There is no lower bound: trusted text that trained the
models, and its copies, are rightly easy.

A code is language, kind of model, length and characters (or the hashes of
words) in one long; the last part is scattered, so that a range of it is a shard
of any n-grams, and its differences are small. The model is counts by code, and
sums of counts by context; both are dealt out into as many shards as the session
has shuffle partitions, and travel as ascending arrays, compressed. Lower orders
and contexts are derived shard by shard and dealt anew; the whole is stored by
shard. Each language has a range of the shards by its share of the documents. To
score, the texts of one language in a scan partition are a batch, or several if
they have over ``MOST_TEXT`` characters, and are stored packed:
it asks once for every distinct n-gram in it that a Bloom filter over the
model's codes doesn't refuse, a shard's requests meet its part of the model, and
what is found goes to the batch, in the order in which it asked, without the
codes: the batch knows them from its texts, and interpolates. So no task holds
the model, and texts are written once and never shuffled.

Characters beyond code 3071 are folded into 1024 codes, words into
``WORD_BITS`` bits; texts begin with start signs, one less than the order, and
end with an end sign.

Defined cases: null text is scored as empty text; null lang is the language
``und``; a language without trusted text (or beyond the ``MOST_LANGUAGES`` most
frequent) has no model: its documents are kept, with null perplexity; labels
that contradict each other count as not trusted, repeated ones once; labels
without a document and null doc_ids are no trusted text; repeated rows are
scored each; a score that equals the ceiling is kept; very long texts are
scored whole; an empty table gives an empty result; other columns are not
looked at (``good_rows`` carries them through).
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from functools import cache, reduce
from hashlib import blake2b
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelmart.llm.common import Workspace, cut, maybe_broadcast, slices, stored, text_key

ORDER = 4
BITS = 12
FOLDED = 3072
#: the word model: its order, and bits of a word's hash
WORD_ORDER = 2
WORD_BITS = 24
START, END = 2, 3
UNIT = ORDER * BITS  # bits of the units' part of a code, in both models
#: the factor that scatters keys, and the one that takes them back
SCATTER = np.uint64(0x9E3779B97F4A7C15)
GATHER = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: (order, bits of a unit) of the character model and of the word model
KINDS = ((ORDER, BITS), (WORD_ORDER, WORD_BITS))
#: a word: a run of letters and signs without blanks, or one letter of a script without spaces
ALONE = ((0xe00, 0xeff), (0x1000, 0x109f), (0x1780, 0x17ff), (0x3040, 0x30ff), (0x3400, 0x9fff), (0xf900, 0xfaff),
         (0x20000, 0x3ffff))
MOST_LANGUAGES = 200
#: quantile of the calibration half that bounds what is kept
HIGH = 0.99
#: and how far, in log perplexity, a text may lie beyond it
MARGIN = 0.1
#: width of a step of log perplexity in the quantile tables
STEP = 0.001
#: characters worked on together, bytes of a blob before packing, n-grams gathered before merging
CHUNK = 1_000_000
BLOB_BYTES = 6_000_000
GATHERED = 1_000_000
#: characters of a batch, and parts of a scan partition's texts of one language
MOST_TEXT = 24_000_000
MOST_IDS = 1_000_000
#: n-grams are numbered by a table of so many places, beyond it by hash
MOST_SPAN = 1 << 24
#: how hard texts are compressed
LEVEL = 9
#: bits of the filter over the model's codes (16 MB)
FILTER_BITS = 1 << 27
#: 64-bit words of the filter that are united together
FILTER_CHUNK = 1 << 13


# units to codes ---------------------------------------------------------------
def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


@cache
def shapes() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is blank, and whether it is a word alone."""
    blank = np.fromiter((chr(i).isspace() for i in range(0x110000)), bool, 0x110000)
    alone = np.zeros(0x110000, bool)
    for low, high in ALONE:
        alone[low:high + 1] = True
    return blank, alone


def hashes_of(words: pa.LargeBinaryArray, bits: int) -> np.ndarray:
    """Codes of words that are given as code points."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, offsets, data = words.buffers()
    places = np.frombuffer(offsets, np.int64)[:len(words) + 1] // 4
    c = np.frombuffer(data, np.uint32)[:places[-1]]
    size = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
    ends = np.append(0, np.cumsum(size))[places].tolist()
    spelt = str(c.tobytes(), "utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    digests = b"".join([blake2b(spelt[a:b], digest_size=8).digest() for a, b in zip(ends, ends[1:])])
    return (np.frombuffer(digests, ">u8") % np.uint64((1 << bits) - 4)).astype(np.int64) + 4


def word_codes_of(texts: list[str], bits: int = WORD_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram key at each word and end sign, number of these by text)."""
    c = code_points([t + "\n" for t in texts])
    close = np.cumsum([len(t) + 1 for t in texts]) - 1
    blank, alone = (table[c] for table in shapes())
    begins = ~blank
    begins[1:] &= blank[:-1] | alone[:-1] | alone[1:]
    words = np.add.reduceat(begins, np.concatenate([[0], close[:-1] + 1]), dtype=np.int64)
    inner = ~blank
    offsets = np.append(np.flatnonzero(begins[inner]), inner.sum()).astype(np.int64) * 4
    spelt = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets), pa.py_buffer(c[inner])]).dictionary_encode()
    hashes = hashes_of(spelt.dictionary, bits)
    n = words + 1
    ends = np.cumsum(n) - 1
    out = np.full(int(n.sum()), END, np.int64)
    own = np.ones(len(out), bool)
    own[ends] = False
    out[own] = hashes[spelt.indices.to_numpy()]
    before = np.concatenate([[START], out[:-1]])
    before[ends[:-1] + 1] = START
    return (before << bits) | out, n


def numbered(x: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(place among the distinct values, distinct values) of numbers below ``span``."""
    if span > MOST_SPAN:
        return pd.factorize(x)
    met = np.zeros(span, bool)
    met[x] = True
    distinct = np.flatnonzero(met)
    place = np.empty(span, np.int32)
    place[distinct] = np.arange(len(distinct), dtype=np.int32)
    return place[x], distinct


def char_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``grams``, of characters: n-grams are numbered a length at a time, so
    that no key is looked up that is longer than the texts' alphabet needs."""
    pad = chr(START) * (ORDER - 1)
    c = code_points([pad + t + chr(END) for t in texts]).astype(np.int32)
    far = np.flatnonzero(c >= FOLDED)
    c[far] = FOLDED + c[far] % 1024
    n = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(n + ORDER - 1) - (n + ORDER - 1)
    own = np.ones(len(c), bool)
    for k in range(ORDER - 1):
        own[begin + k] = False
    signs, alphabet = numbered(c, 1 << BITS)
    at, keys = signs, alphabet
    for k in range(1, ORDER):
        span = len(keys) * len(alphabet)
        wide = at[:-1].astype(np.int32 if span < 1 << 31 else np.int64) * len(alphabet) + signs[k:]
        if k == ORDER - 1:
            wide = wide[own[k:]]
        at, distinct = numbered(wide, span)
        keys = (keys[distinct // len(alphabet)] << BITS) | alphabet[distinct % len(alphabet)]
    return at, keys, n


def grams(texts: list[str], kind: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each unit's and end sign's n-gram among the keys, distinct keys,
    number of these units by text); ``kind`` 0: characters, 1: words."""
    if not kind:
        return char_grams(texts)
    keys, n = word_codes_of(texts, bits)
    return *pd.factorize(keys), n


def chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def number(lang: int, kind: int) -> int:
    """Languages are numbered for each kind of model."""
    return 2 * lang + kind


def coded(tag, key: np.ndarray, width) -> np.ndarray:
    """Codes of keys of so many bits (at most ``UNIT``): the keys, scattered, are
    the leading bits behind the tag."""
    width = np.asarray(width).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = key.astype(np.uint64) * SCATTER & (np.uint64(1) << width) - np.uint64(1)
    return (key << np.uint64(UNIT) - width).astype(np.int64) | tag << UNIT


def tagged(lang: int, length: int, key: np.ndarray, bits: int) -> np.ndarray:
    return coded(lang << 3 | length, key, bits * length)


def distinct_of(x: np.ndarray) -> np.ndarray:
    """Like ``np.unique``, by sorting: its hash table takes ten times as long."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def found_in(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Like ``np.searchsorted``, for many values in any order: ascending ones find their place sooner."""
    order = np.argsort(x)
    out = np.empty(len(x), np.int64)
    out[order] = np.searchsorted(table, x[order])
    return out


# tables of codes ---------------------------------------------------------------
def planes(columns: Iterable[np.ndarray]) -> bytes:
    """Columns of longs as compressed planes of bytes."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(
        np.ascontiguousarray(c.astype(np.int64, copy=False)).view(np.uint8).reshape(-1, 8).T.tobytes()
        for c in columns))


def values_of(blob: bytes, width: int) -> list[np.ndarray]:
    each = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(width, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in each]


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of longs, the first ascending."""
    return planes([np.diff(columns[0], prepend=0), *columns[1:]])


def columns_of(blob: bytes, width: int) -> list[np.ndarray]:
    first, *rest = values_of(blob, width)
    return [np.cumsum(first), *rest]


def summed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct codes, ascending, and the sums of their other columns."""
    order = np.argsort(columns[0], kind="stable")
    code = columns[0][order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, int)
    return [code[first], *[np.add.reduceat(c[order], first) if len(first) else c for c in columns[1:]]]


class Shares:
    """Ranges of ``shards`` shards, one for each language, by its weight: what a
    batch of one language asks for lies in few of them."""

    def __init__(self, shards: int, weights: list[int]):
        self.shards, total = shards, max(1, sum(weights))
        edges = np.array([(end * shards << 10) // total for end in accumulate(weights, initial=0)], np.int64)
        self.low, self.width = edges[:-1], np.diff(edges)  # in shards / 1024

    def of(self, codes: np.ndarray) -> np.ndarray:
        lang = codes >> UNIT + 4
        place = self.low[lang] + ((codes >> UNIT - 32 & 0xFFFFFFFF) * self.width[lang] >> 32)
        return np.minimum(place >> 10, self.shards - 1)


def places_by_shard(codes: np.ndarray, shards: int | Shares) -> dict[int, np.ndarray]:
    """The places of the codes of each shard, which is a range of scattered keys
    (of some languages, if they have shares)."""
    n, whole = (shards.shards, False) if isinstance(shards, Shares) else (shards, True)
    shard = (codes >> UNIT - 32 & 0xFFFFFFFF) * n >> 32 if whole else shards.of(codes)
    shard = shard.astype(np.uint16 if n < 1 << 16 else np.int64)
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    return dict(zip(found.tolist(), np.split(order, first[1:])))


def dealt(columns: list[np.ndarray], shards: int | Shares) -> tuple[list[int], list[bytes]]:
    """Ascending codes dealt out: the shards that get some, and a blob for each."""
    by = places_by_shard(columns[0], shards)
    return list(by), [packed([c[at] for c in columns]) for at in by.values()]


def shard_rows(columns: list[np.ndarray], shards: int | Shares) -> pa.RecordBatch:
    found, blobs = dealt(columns, shards)
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def joined(blobs: Iterable[bytes], width: int) -> list[np.ndarray]:
    each = [columns_of(b, width) for b in blobs]
    return [np.concatenate(c) for c in zip(*each)] if each else [np.zeros(0, np.int64)] * width


def merged(parts: DataFrame) -> DataFrame:
    """(shard, blob) of codes and counts -> one row a shard, counts of a code summed."""
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"shard": table.column("shard")[:1], "blob": pa.array(
            [packed(summed(joined(table.column("blob").to_pylist(), 2)))], pa.binary())})
    return parts.groupBy("shard").applyInArrow(run, "shard int, blob binary")


def count_batches(langs: dict[str, int], kinds: tuple, shards: int | Shares):
    """Texts -> (shard, blob): counts of the n-grams of the highest orders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in slices(batches):
            frame = pd.DataFrame({"lang": batch.column("lang").to_pylist(),
                                  "text": batch.column("text").to_pylist()})
            for lang, part in frame.groupby("lang", sort=True):
                if lang not in langs:
                    continue
                for texts in chunks([t or "" for t in part["text"]]):
                    for kind, (order, bits) in enumerate(kinds):
                        at, keys, _ = grams(texts, kind, bits)
                        held.append([tagged(number(langs[lang], kind), order, keys, bits), np.bincount(at)])
            if sum(len(h[0]) for h in held) > GATHERED:
                held = [summed([np.concatenate(c) for c in zip(*held)])]
                if len(held[0][0]) > GATHERED // 2:
                    yield shard_rows(held.pop(), shards)
        if held:
            yield shard_rows(summed([np.concatenate(c) for c in zip(*held)]), shards)
    return run


# the model --------------------------------------------------------------------
def spread(codes: np.ndarray, kinds: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tag, length, bits of a unit, key) of codes."""
    tag = codes >> UNIT
    length, bits = tag & 7, np.array([bits for _, bits in kinds])[(tag >> 3) & 1]
    width = (bits * length).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = ((codes & ((1 << UNIT) - 1)).astype(np.uint64) >> np.uint64(UNIT) - width) * GATHER
    return tag, length, bits, (key & (np.uint64(1) << width) - np.uint64(1)).astype(np.int64)


def by_blob(kinds: tuple, shards: int | Shares, width: int, change):
    """Applies ``change`` to the columns of each blob and deals the result out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                yield shard_rows(change(columns_of(blob, width), kinds), shards)
    return run


def lower(columns: list[np.ndarray], kinds: tuple) -> list[np.ndarray]:
    """Continuation counts: the distinct units before each code without its first unit."""
    code = columns[0]
    tag, length, bits, key = spread(code[((code >> UNIT) & 7) > 1], kinds)
    width = bits * (length - 1)
    return list(np.unique(coded(tag - 1, key & ((1 << width) - 1), width), return_counts=True))


def contexts(columns: list[np.ndarray], kinds: tuple) -> list[np.ndarray]:
    """Of the codes without their last unit: sum of counts, and how many counts
    are 1, 2 and more."""
    code, c = columns
    tag, length, bits, key = spread(code, kinds)
    return summed([coded(tag - 1, key >> bits, bits * (length - 1)), c,
                   *[(f).astype(np.int64) for f in (c == 1, c == 2, c > 2)]])


def counts_of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("blob").to_pylist():
            code, c = columns_of(blob, 2)
            tag, *n = summed([code >> UNIT, *[(c == i).astype(np.int64) for i in (1, 2, 3, 4)]])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tag, *n)], ["tag", "n1", "n2", "n3", "n4"])


def discounts(n: list[int]) -> list[float]:
    """From how many codes were counted once to four times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.0
    return [max(0.05, min(i - 0.05, i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else i / 2.0)) for i in (1, 2, 3)]


def whole(longest: pa.Table, rest: pa.Table) -> pa.Table:
    """A shard of the model as one blob: of each code its count, and the sums of
    the counts behind it."""
    sums = pc.field("sums")
    counted, c = summed(joined(longest.column("blob").to_pylist() + rest.filter(~sums).column("blob").to_pylist(), 2))
    before, *sums_of = summed(joined(rest.filter(sums).column("blob").to_pylist(), 5))
    code = distinct_of(np.concatenate([counted, before]))
    columns = np.zeros((5, len(code)), np.int64)
    columns[0, np.searchsorted(code, counted)] = c
    columns[1:, np.searchsorted(code, before)] = sums_of
    shard = (longest if len(longest) else rest).column("shard")[:1]
    return pa.table({"shard": shard, "blob": pa.array([packed([code, *columns])], pa.binary())})


def model(texts: DataFrame, langs: dict[str, int], deal: Shares, work: Workspace) -> tuple[DataFrame, dict[int, list[float]]]:
    """Trusted texts -> the counts of all orders and the sums of all contexts (a
    blob for each shard, stored by shard), and the discounts of each tag. Each
    level is stored once, until the whole is; the longest n-grams, nearly all of
    it, stay in their shard. Probabilities come from these when a batch is scored."""
    kinds, shards = KINDS, deal.shards
    rows = "shard int, blob binary"
    level = [work.put_bucketed(merged(texts.mapInArrow(count_batches(langs, kinds, deal), rows)), "level0", "shard", shards)]
    for k in range(1, max(order for order, _ in kinds)):
        level.append(work.put(merged(level[-1].mapInArrow(by_blob(kinds, deal, 2, lower), rows)), f"level{k}"))
    every = reduce(DataFrame.unionByName, level)
    seen = every.mapInArrow(counts_of_counts, "tag long, n1 long, n2 long, n3 long, n4 long").groupBy("tag").agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in (1, 2, 3, 4)])
    law = {r[0]: discounts(list(r)[1:]) for r in seen.collect()}  # at most languages x orders
    rest = every.mapInArrow(by_blob(kinds, deal, 2, contexts), rows).withColumn("sums", F.lit(True))
    for shorter in level[1:]:
        rest = rest.unionByName(shorter.withColumn("sums", F.lit(False)))
    table = work.put_bucketed(level[0].groupBy("shard").cogroup(rest.groupBy("shard")).applyInArrow(whole, rows),
                              "model", "shard", shards)
    work.drop(*[f"level{k}" for k in range(len(level))])
    return table, law


def shard_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# which codes the model may have ------------------------------------------------
def places(codes: np.ndarray) -> list[np.ndarray]:
    """The bits of a code in the filter."""
    with np.errstate(over="ignore"):
        h = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD1342543DE82EF95)
        h ^= h >> np.uint64(29)
    mask = np.uint64(FILTER_BITS - 1)
    return [h & mask, (h >> np.uint64(20)) & mask, (h >> np.uint64(37)) & mask]


def codes_in(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The codes in a column of codes, or in blobs of the model."""
    if "code" in batch.schema.names:
        yield batch.column("code").to_numpy()
    else:
        yield from (columns_of(blob, 6)[0] for blob in batch.column("blob").to_pylist())


def filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, bits) of the filter as far as one task's codes set them."""
    words = np.zeros(FILTER_BITS >> 6, np.uint64)
    for codes in (codes for batch in batches for codes in codes_in(batch)):
        for at in places(codes):
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    pack = zstandard.ZstdCompressor(level=1)
    for i in range(0, len(words), FILTER_CHUNK):
        if words[i:i + FILTER_CHUNK].any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // FILTER_CHUNK], pa.int32()),
                 pa.array([pack.compress(words[i:i + FILTER_CHUNK].tobytes())], pa.binary())], ["chunk", "bits"])


def filter_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by chunk -> a row for each chunk, all its parts united."""
    unpack, now, words = zstandard.ZstdDecompressor(), None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([words.tobytes()], pa.binary())],
                                          ["chunk", "bits"])
    for batch in batches:
        for chunk, bits in zip(batch.column("chunk").to_pylist(), batch.column("bits").to_pylist()):
            if chunk != now:
                if now is not None:
                    yield done()
                now, words = chunk, np.zeros(FILTER_CHUNK, np.uint64)
            words |= np.frombuffer(unpack.decompress(bits), np.uint64)
    if now is not None:
        yield done()


def code_filter(table: DataFrame) -> np.ndarray:
    """A Bloom filter over the model's codes, of a fixed size whatever the
    model's: a code that it refuses is not in the model."""
    kind = "chunk int, bits binary"
    chunks = (table.mapInArrow(filter_parts, kind).repartition("chunk")
              .sortWithinPartitions("chunk").mapInArrow(filter_chunks, kind).collect())
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    for r in chunks:
        out[r["chunk"] * FILTER_CHUNK:][:FILTER_CHUNK] = np.frombuffer(r["bits"], np.uint64)
    return out


def maybe_met(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The codes that the filter doesn't refuse."""
    keep = np.ones(len(codes), bool)
    for at in places(codes):
        keep &= (known[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return codes[keep]


# scoring ----------------------------------------------------------------------
def pack(langs: dict[str, int]):
    """Rows of a scan partition as compressed blobs of a few megabytes of rows,
    by batch: one language, and ``MOST_TEXT`` characters of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size: dict[int, int] = {}
        for batch in batches:
            numbers = np.array([langs.get(x, MOST_LANGUAGES) for x in batch.column("lang").to_pylist()])
            for lang in np.unique(numbers).tolist():
                rows = pa.Table.from_batches([batch]).take(pa.array(np.flatnonzero(numbers == lang)))
                part, rows = rows.column("part")[0].as_py(), rows.drop_columns(["part"])
                step = max(1, rows.num_rows * BLOB_BYTES // max(1, rows.nbytes))
                for a in range(0, rows.num_rows, step):
                    some, sink = rows.slice(a, step), io.BytesIO()
                    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(
                            compression=pa.Codec("zstd", compression_level=LEVEL))) as out:
                        out.write_table(some)
                    held = size[lang] = size.get(lang, 0) + (pc.sum(pc.utf8_length(some.column("text"))).as_py() or 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(part << 8 | lang) << 24 | held // MOST_TEXT], pa.int64()),
                         pa.array([sink.getvalue()], pa.binary())], ["batch", "blob"])
    return run


def unpacked(blobs: pa.Table) -> Iterator[tuple[pa.Table, dict[str, list[int]]]]:
    """Each blob's rows, and row numbers by language."""
    for blob in blobs.column("blob"):
        rows = pa.ipc.open_stream(blob.as_py()).read_all()
        by: dict[str, list[int]] = {}
        for i, lang in enumerate(rows.column("lang").to_pylist()):
            by.setdefault(lang, []).append(i)
        yield rows, by


def asked(lang: int, keys: np.ndarray, order: int, bits: int) -> Iterator[np.ndarray]:
    """Codes of all orders and contexts that scoring these n-grams looks at, the
    codes of one length at a time, each once."""
    for length in range(order, -1, -1):
        own = [keys & ((1 << bits * length) - 1)] if length else []
        contexts = [(keys & ((1 << bits * (length + 1)) - 1)) >> bits] if length < order else []
        yield tagged(lang, length, distinct_of(np.concatenate(own + contexts)), bits)


def tokens(rows: pa.Table, by: dict[str, list[int]], langs: dict[str, int], kinds: tuple, which: tuple[int, ...]):
    """A blob's n-grams by language, of some kinds, a chunk of texts at a time:
    (number of the model, row numbers, place of each n-gram, keys, n-grams by text)."""
    texts = rows.column("text").to_pylist()
    for lang, own in by.items():
        done = 0
        for some in chunks([texts[i] or "" for i in own]) if lang in langs else ():
            for kind in which:
                yield number(langs[lang], kind), own[done:done + len(some)], *grams(some, kind, kinds[kind][1])
            done += len(some)


def gather(found: dict[int, list[np.ndarray]], k: int, keys: np.ndarray) -> None:
    held = found.setdefault(k, [])
    held.append(keys)
    if sum(map(len, held[1:])) > GATHERED:
        held[:] = [distinct_of(np.concatenate(held))]


def wanted(found: dict[int, list[np.ndarray]], kinds: tuple, known: np.ndarray) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """A batch's distinct n-grams by model, and the codes that scoring them looks
    up, ascending, once each."""
    keys = {k: distinct_of(np.concatenate(found[k])) for k in sorted(found)}
    met = [np.zeros(0, np.int64)]
    for k, own in keys.items():
        for codes in asked(k, own, *kinds[k % 2]):
            met += [maybe_met(known, codes[a:a + CHUNK]) for a in range(0, len(codes), CHUNK)]
    return keys, np.sort(np.concatenate(met))


def requester(langs: dict[str, int], kinds: tuple, known: np.ndarray, shards: int | Shares):
    """A batch's packed texts -> (shard, batch, blob): the codes it asks for."""
    def run(blobs: pa.Table) -> pa.Table:
        found: dict[int, list[np.ndarray]] = {}
        for rows, by in unpacked(blobs):
            for k, _, _, keys, _ in tokens(rows, by, langs, kinds, (0, 1)):
                gather(found, k, keys)
        to, codes = dealt([wanted(found, kinds, known)[1]], shards)
        return pa.table({"shard": pa.array(to, pa.int32()),
                         "batch": pa.array([blobs.column("batch")[0].as_py()] * len(to), pa.int64()),
                         "blob": pa.array(codes, pa.binary())})
    return run


def answer(requests: pa.Table, part: pa.Table) -> pa.Table:
    """One shard's requests and its part of the model -> (batch, shard, blob): the
    counts and contexts of the codes, in the order of the request, 0 if unknown."""
    own, *values = joined(part.column("blob").to_pylist(), 6)
    out = []
    for blob in requests.column("blob").to_pylist():
        code, = columns_of(blob, 1)
        at = np.minimum(np.searchsorted(own, code), max(0, len(own) - 1))
        hit = own[at] == code if len(own) else np.zeros(len(code), bool)
        out.append(planes([np.where(hit, v[at], 0) if len(own) else np.zeros(len(code), np.int64) for v in values]))
    return pa.table({"batch": requests.column("batch"), "shard": requests.column("shard"),
                     "blob": pa.array(out, pa.binary())})


class Answers:
    """The part of the model that one batch asked for, by ``codes``."""

    def __init__(self, codes: np.ndarray, answers: pa.Table, shards: int | Shares, law: dict[int, list[float]]):
        values = np.zeros((5, len(codes)), np.uint32)
        by = places_by_shard(codes, shards)
        for shard, blob in zip(answers.column("shard").to_pylist(), answers.column("blob")):
            part = np.array(values_of(blob.as_py(), 5))
            if part.size and part.max() >> 32:  # few counts take over four bytes
                values = values.astype(np.int64, copy=False)
            values[:, by[shard]] = part
        self.code, self.c, self.sums, self.law = codes, values[0], values[1:], law

    def find(self, codes: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Values of codes; 0 where the model has none."""
        if not len(self.code):
            return np.zeros((*values.shape[:-1], len(codes)), np.int64)
        at = np.minimum(found_in(self.code, codes), len(self.code) - 1)
        return np.where(self.code[at] == codes, values[..., at], 0).astype(np.int64)

    def log_p(self, lang: int, keys: np.ndarray, order: int, bits: int) -> np.ndarray:
        """Interpolated from the shortest n-gram up; in single precision where a
        model's table would hold it, so that a met n-gram's own lower orders alone
        are exact."""
        p = exact = np.full(len(keys), 1.0 / (1 << bits))
        for k in range(1, order + 1):
            law = self.law.get(lang << 3 | k)
            if law is None:
                continue
            own, place = np.unique(keys & ((1 << bits * k) - 1), return_inverse=True)
            c = self.find(tagged(lang, k, own, bits), self.c)[place]
            total, *n = self.find(tagged(lang, k - 1, own >> bits, bits), self.sums)[:, place]
            behind = np.maximum(total, 1)
            g = np.where(total > 0, sum(d * x for d, x in zip(law, n)) / behind, 1.0)
            exact = (c - np.array([0.0, *law])[np.minimum(c, 3)]) / behind + g * exact
            p = np.where(c > 0, single(exact), single(g) * p)
        return np.log(p)


def single(x: np.ndarray) -> np.ndarray:
    return x.astype(np.float32).astype(float)


def score_batch(langs: dict[str, int], kinds: tuple, known: np.ndarray, shards: int | Shares, law: dict[int, list[float]]):
    """A batch's packed texts and answers -> its rows without texts, scored. Words
    are held from the first pass over the texts to the second, characters are not."""
    def run(blobs: pa.Table, answers: pa.Table) -> pa.Table:
        found: dict[int, list[np.ndarray]] = {}
        words: list[list[tuple]] = []
        for rows, by in unpacked(blobs):
            words.append([])
            for k, own, at, keys, n in tokens(rows, by, langs, kinds, (0, 1)):
                gather(found, k, keys)
                if k % 2:
                    words[-1].append((k, own, at.astype(np.uint32), keys, n))
        every, codes = wanted(found, kinds, known)
        table, out = Answers(codes, answers, shards, law), []
        log_p = {k: np.concatenate([table.log_p(k, keys[a:a + GATHERED // 4], *kinds[k % 2])
                                    for a in range(0, len(keys), GATHERED // 4)]) for k, keys in every.items()}
        for (rows, by), held in zip(unpacked(blobs), words):
            log_ppl = np.full((len(kinds), len(rows)), np.nan)
            for k, own, at, keys, n in chain(tokens(rows, by, langs, kinds, (0,)), held):
                each = log_p[k][found_in(every[k], keys)][at]
                log_ppl[k % 2, own] = -np.add.reduceat(each, np.cumsum(n) - n) / n
            rows = rows.drop_columns(["text"])
            for name, values in zip(("log_ppl", "word_log_ppl"), log_ppl):
                rows = rows.append_column(name, pa.array(values, from_pandas=True))
            out.append(rows)
        return pa.concat_tables(out)
    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, fold) of trusted documents; fold 0 trains, fold 1 calibrates."""
    each = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return each.where("q = 1 and coalesce(t, 0) = 0").select(
        F.col("doc_id").alias("_id"), (F.crc32(F.col("doc_id").cast("string")) % 2).cast("int").alias("fold"))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, th, lang, fold, log_ppl, word_log_ppl): narrow, one row for each
    document, stored. All else that is written on the way is deleted."""
    spark = docs.sparkSession
    work = Workspace(spark, "kneser_ney")
    ids = work.put(trusted_ids(labels), "ids")
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    rows = docs.select("doc_id", text_key().alias("th"), lang.alias("lang"), "text")
    common = (docs.groupBy(lang.alias("lang")).count().orderBy(F.desc("count"), "lang")
              .limit(MOST_LANGUAGES).collect())
    common = sorted(common, key=lambda r: r["lang"])
    langs = {r["lang"]: i for i, r in enumerate(common)}
    deal = Shares(shard_count(spark), [r["count"] for r in common])
    train = ids.where("fold = 0").select("_id")
    train = rows.join(maybe_broadcast(train, train.count(), MOST_IDS), F.col("doc_id") == F.col("_id"), "left_semi")
    table, law = model(train, langs, deal, work)
    trained = {tag >> 4 for tag in law}  # at most MOST_LANGUAGES
    langs = {lang: i for lang, i in langs.items() if i in trained}
    kind, kinds = dict(docs.dtypes)["doc_id"], KINDS
    known = code_filter(table.select("blob"))
    # stored once, by batch: whoever asks and whoever scores sees the same whole batches, and no text is moved
    texts = work.put_bucketed(
        rows.withColumn("part", F.spark_partition_id()).mapInArrow(pack(langs), "batch long, blob binary"),
        "packed", "batch", deal.shards)
    requests = texts.groupBy("batch").applyInArrow(
        requester(langs, kinds, known, deal), "shard int, batch long, blob binary")
    answers = requests.groupBy("shard").cogroup(table.groupBy("shard")).applyInArrow(
        answer, "batch long, shard int, blob binary")
    scored = work.put(texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        score_batch(langs, kinds, known, deal, law),
        f"doc_id {kind}, th long, lang string, log_ppl double, word_log_ppl double"), "scored")
    scored = stored(scored.join(maybe_broadcast(ids, ids.count()), F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "th", "lang", "fold", "log_ppl", "word_log_ppl"), "scores")
    work.close()
    return scored


def limits(scored: DataFrame, high: float = HIGH, margin: float = MARGIN,
           score: str = "log_ppl") -> DataFrame:
    """(lang, ceiling) in log perplexity: the quantile of the calibration half,
    on a grid of STEP, so that it doesn't depend on the order of rows."""
    steps = scored.where((F.col("fold") == 1) & F.col(score).isNotNull()).groupBy(
        "lang", F.round(F.col(score) / STEP).cast("int").alias("step")).agg(F.count("*").alias("n"))
    line = Window.partitionBy("lang").orderBy("step")
    ranked = steps.withColumn("upto", F.sum("n").over(line)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("lang")))
    return ranked.groupBy("lang").agg(
        (F.min(F.when(F.col("upto") >= high * F.col("all"), F.col("step"))) * STEP + margin).alias("ceiling"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, perplexity, ceiling, word_perplexity, word_ceiling, kept,
    th) of every row."""
    scored = scores(docs, labels)
    words = limits(scored, score="word_log_ppl").withColumnRenamed("ceiling", "word_ceiling")
    bounds = cut(limits(scored).join(words, "lang", "full_outer"))
    bounds = maybe_broadcast(bounds.withColumnRenamed("lang", "_l"), bounds.count())
    low = [F.coalesce(F.col(a) <= F.col(b), F.lit(True))
           for a, b in (("log_ppl", "ceiling"), ("word_log_ppl", "word_ceiling"))]
    return scored.join(bounds, F.col("lang") == F.col("_l"), "left").select(
        "doc_id", "lang", F.exp("log_ppl").alias("perplexity"), F.exp("ceiling").alias("ceiling"),
        F.exp("word_log_ppl").alias("word_perplexity"), F.exp("word_ceiling").alias("word_ceiling"),
        (low[0] & low[1]).alias("kept"), "th")


def good_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept. A row is known by its
    id, text and language, so equal texts of one id may fare unlike."""
    bad = cut(judge(docs, labels).where("not kept").select(
        F.col("doc_id").alias("_b_id"), F.col("th").alias("_b_th"), F.col("lang").alias("_b_lang")).distinct())
    bad = maybe_broadcast(bad, bad.count(), MOST_IDS)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_b_id"]) & (text_key() == bad["_b_th"])
                     & (F.coalesce(docs["lang"], F.lit("und")) == bad["_b_lang"]), "left_anti")
