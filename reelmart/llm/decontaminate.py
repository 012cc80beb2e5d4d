"""Benchmark decontamination: CGK embedding, bit-sampling LSH, edit verification.

Texts and items are sequences of words (lower-cased, all but letters, marks and
digits parts them; in scripts without spaces each letter is a word).
The CGK random walk copies a word to the output and moves on, or stays, by a
random bit of (step, word); sequences a few edits apart then have outputs a
small Hamming distance apart. Each run samples a few output steps; a window of
a text is a candidate for an item if its words at these steps are the item's.
Runs are repeated until the target recall. Windows are as long as the items of
their class (sizes within 25 %). A candidate is verified exactly: the least
word edit distance between the item and any stretch of the text around the
window, at most ``MOST_EDITS`` of the item's words.

Before the walks a window must hold enough words that occur in the class's
items at all; a match within ``MOST_EDITS`` always does, so this loses nothing.

The work is a map over whole texts; nothing is shuffled. Items go to the tasks
in blocks of at most ``BLOCK_ITEMS``, one pass each, so that what is sent never
grows with the benchmark.

Items of fewer than ``MIN_ITEM`` words are too short for edits and are searched
exactly: their whole sequence of words, without an edit.

Defined cases: null and blank texts match nothing; items that are null or hold
no word at all match nothing; items of equal text are found each; repeated rows each give their matches;
of stretches with equally few edits the first is told; very long texts are
searched whole; doc_id and item_id may be null; empty tables give an empty
result; other columns are not looked at (``clean_rows`` carries them through).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import slices

MIN_ITEM = 5
MOST_EDITS = 0.2
#: steps sampled in a run, and runs; see ``runs_for``
SAMPLED = 3
RECALL = 0.99
#: chance that one sampled step agrees for a pair at MOST_EDITS, as measured on
#: random edits of random sequences (tests/llm holds it against that)
AGREE = 0.58
GROWTH = 1.25
BLOCK_ITEMS = 2000
#: words walked together
CHUNK = 400_000
SIGNS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SEED = 20_240_817
#: scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Han
UNSPACED = ((0x0e00, 0x0eff), (0x1000, 0x109f), (0x1780, 0x17ff), (0x3005, 0x3007), (0x3041, 0x30ff),
            (0x31f0, 0x31ff), (0x3400, 0x9fff), (0xf900, 0xfaff), (0xff66, 0xff9f), (0x20000, 0x3ffff))


def _class(unspaced: bool) -> str:
    """The letters, marks and digits in or outside of UNSPACED, for a regular expression."""
    out, last = [], None
    for c in range(0x40000):
        if (unicodedata.category(chr(c))[0] in "LMN"
                and any(a <= c <= b for a, b in UNSPACED) == unspaced):
            if last is None or c != last + 1:
                out.append([c, c])
            out[-1][1] = last = c
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


TOKEN = re.compile(f"[{_class(True)}]|[{_class(False)}]+")


def runs_for(recall: float = RECALL, agree: float = AGREE, sampled: int = SAMPLED) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - agree ** sampled))


def words_of(text: str | None) -> list[bytes]:
    if not text:
        return []
    text = text.lower()
    if text.isascii():
        return text.encode().translate(SIGNS).split()
    return [w.encode() for w in TOKEN.findall(text)]


class Search:
    """The items of one block, by size class, with their sampled embeddings."""

    def __init__(self, items: list[tuple], most_edits: float = MOST_EDITS, runs: int | None = None):
        self.most_edits = most_edits
        known = [(key, words_of(text)) for key, text in items]
        known = sorted(((key, w) for key, w in known if w), key=lambda x: len(x[1]))
        self.vocabulary: dict[bytes, int] = {}
        for _, w in known:
            for word in w:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        size = len(self.vocabulary) + 2  # 0: any other word; the last: beyond the end
        self.end = size - 1
        self.keys = [key for key, _ in known]
        self.items = [np.array([self.vocabulary[x] for x in w], np.int32) for _, w in known]
        self.longest = max((len(i) for i in self.items), default=0)
        self.classes = []
        number = sum(len(i) < MIN_ITEM for i in self.items)
        self.short = self._short(number, size)
        while number < len(self.items):
            low = len(self.items[number])
            last = number
            while last < len(self.items) and len(self.items[last]) <= max(low, GROWTH * low):
                last += 1
            own = list(range(number, last))
            member = np.zeros(size, bool)
            for i in own:
                member[self.items[i]] = True
            self.classes.append((low, own, member, self._runs(low, own, size, number, runs)))
            number = last

    def _short(self, number: int, size: int) -> list[tuple[np.ndarray, dict[int, list[int]]]]:
        """For each length: the (beginning, word) codes that go on, sorted, and
        the items that end with a beginning, numbered by its place among them."""
        out, held = [], {i: 0 for i in range(number)}
        for k in range(max((len(self.items[i]) for i in held), default=0)):
            held = {i: b * size + int(self.items[i][k]) for i, b in held.items() if len(self.items[i]) > k}
            codes = np.unique(np.array(list(held.values()), np.int64))
            held = {i: int(np.searchsorted(codes, c)) for i, c in held.items()}
            ends: dict[int, list[int]] = {}
            for i, b in held.items():
                if len(self.items[i]) == k + 1:
                    ends.setdefault(b, []).append(i)
            out.append((codes, ends))
        return out

    def exact(self, ids: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """(short item, starts of its whole sequence of words)."""
        at, begun = np.arange(n if self.short else 0), np.zeros(n if self.short else 0, np.int64)
        for k, (codes, ends) in enumerate(self.short):
            code = begun * (self.end + 1) + ids[at + k]
            begun = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            met = codes[begun] == code
            at, begun = at[met], begun[met]
            for b in np.intersect1d(begun, np.array(list(ends), np.int64)).tolist():
                for item in ends[b]:
                    yield item, at[begun == b]

    def _runs(self, low: int, own: list[int], size: int, salt: int, runs: int | None) -> list:
        rng = np.random.default_rng([SEED, salt])
        span = max(SAMPLED, int(1.5 * low))
        pad = max(len(self.items[i]) for i in own) + span
        ids = np.full((len(own), pad), self.end, np.int32)
        for row, i in enumerate(own):
            ids[row, :len(self.items[i])] = self.items[i]
        starts = np.arange(len(own)) * pad
        out = []
        for _ in range(runs or runs_for()):
            steps = np.sort(rng.choice(span, SAMPLED, replace=False))
            bits = rng.integers(0, 1 << 63, size=((span + 62) // 63, size), dtype=np.int64)
            bits[:, self.end] = 0
            seen = self._walk(ids.ravel(), starts, steps, bits)
            table: dict[int, dict] = {}
            allowed = []
            at = seen[:, 0].astype(np.int64)
            first = np.zeros(size, bool)
            first[at] = True
            for s in range(1, SAMPLED):
                at = at * size + seen[:, s]
                allowed.append(np.unique(at))
            for row, k in enumerate(at.tolist()):
                table.setdefault(k, []).append(own[row])
            out.append((steps, bits, first, allowed, table, size))
        return out

    @staticmethod
    def _walk(ids: np.ndarray, starts: np.ndarray, steps: np.ndarray, bits: np.ndarray) -> np.ndarray:
        at, seen, taken = starts.copy(), [], 0
        for step in range(int(steps[-1]) + 1):
            here = ids[at]
            if step == steps[taken]:
                seen.append(here)
                taken += 1
                if taken == len(steps):
                    break
            at += (bits[step // 63, here] >> (step % 63)) & 1
        return np.stack(seen, axis=1)

    def candidates(self, ids: np.ndarray, n: int) -> dict[int, np.ndarray]:
        """Item -> window starts, over ``n`` words (padding follows them)."""
        found: dict[int, list] = {}
        for low, own, member, runs in self.classes:
            known = np.concatenate([[0], np.cumsum(member[ids])])
            need = low - int(self.most_edits * low)
            width = min(low + int(self.most_edits * low), len(ids))
            ends = np.minimum(np.arange(n) + width, len(ids))
            starts = np.flatnonzero(known[ends] - known[:n] >= need)
            if not len(starts):
                continue
            for steps, bits, first, allowed, table, size in runs:
                at, key, taken = starts, None, 0
                pos = starts.copy()
                for step in range(int(steps[-1]) + 1):
                    here = ids[pos]
                    if step == steps[taken]:
                        if taken == 0:
                            keep = first[here]
                            key = here.astype(np.int64)
                        else:
                            key = key * size + here
                            good = allowed[taken - 1]
                            near = np.minimum(np.searchsorted(good, key), len(good) - 1)
                            keep = good[near] == key
                        at, pos, key, here = at[keep], pos[keep], key[keep], here[keep]
                        taken += 1
                        if taken == len(steps) or not len(at):
                            break
                    pos = pos + ((bits[step // 63, here] >> (step % 63)) & 1)
                for start, k in zip(at.tolist(), key.tolist() if key is not None else []):
                    for item in table.get(k, ()):
                        found.setdefault(item, []).append(start)
        return {item: np.unique(s) for item, s in found.items()}

    def verified(self, ids: np.ndarray, item: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edit distance, end) of the best stretch near each start."""
        word = self.items[item]
        n = len(word)
        slack = int(self.most_edits * n) + 1
        width = n + 3 * slack
        base = np.maximum(starts - slack, 0)
        region = ids[np.minimum(base[:, None] + np.arange(width), len(ids) - 1)]
        row = self._edits(region, word, np.zeros(width + 1, np.int32))
        best = row.argmin(axis=1)
        return row[np.arange(len(starts)), best], base + best

    def begin(self, ids: np.ndarray, item: int, end: int) -> int:
        """Where the best stretch that ends before word ``end`` begins."""
        word = self.items[item]
        back = ids[max(0, end - len(word) - int(self.most_edits * len(word)) - 1):end][::-1]
        row = self._edits(back[None, :], word[::-1], np.arange(len(back) + 1, dtype=np.int32))
        return end - int(row[0].argmin())

    @staticmethod
    def _edits(region: np.ndarray, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Word edits between ``word`` and each region's stretches, by their end."""
        line = np.arange(region.shape[1] + 1)
        row = np.tile(row, (len(region), 1))
        for i in range(len(word)):
            new = np.empty_like(row)
            new[:, 0] = i + 1
            new[:, 1:] = np.minimum(row[:, :-1] + (region != word[i]), row[:, 1:] + 1)
            row = np.minimum.accumulate(new - line, axis=1) + line
        return row

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, first word of the stretch, distance, end word)."""
        if not self.items:
            return []
        out: list[tuple] = []
        held: list[int] = []
        words: list[list[bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            w = words_of(text)
            if w:
                held.append(i)
                words.append(w)
                size += len(w)
            if size >= CHUNK or (i == len(texts) - 1 and words):
                out += self._chunk(held, words)
                held, words, size = [], [], 0
        return out

    def _chunk(self, held: list[int], words: list[list[bytes]]) -> list[tuple]:
        gap = 3 * self.longest + 8
        total = sum(map(len, words)) + gap * len(words)
        ids = np.full(total, self.end, np.int32)
        begin, at = [], 0
        get = self.vocabulary.get
        for w in words:
            begin.append(at)
            ids[at:at + len(w)] = list(map(get, w, repeat(0)))
            at += len(w) + gap
        begins = np.array(begin)
        best: dict[tuple[int, int], tuple] = {}
        for item, starts in self.candidates(ids, total - gap).items():
            limit = int(self.most_edits * len(self.items[item]))
            for a in range(0, len(starts), 4000):
                few = starts[a:a + 4000]
                distance, ends = self.verified(ids, item, few)
                for d, end in sorted(set(zip(distance.tolist(), ends.tolist()))):
                    if d > limit:
                        continue
                    doc = int(np.searchsorted(begins, end - 1, "right")) - 1
                    got = (d, self.begin(ids, item, end) - begin[doc], end - begin[doc])
                    if got < best.get((doc, item), (1 << 30,)):
                        best[doc, item] = got
        for item, starts in self.exact(ids, total - gap):
            docs, first = np.unique(np.searchsorted(begins, starts, "right") - 1, return_index=True)
            for doc, start in zip(docs.tolist(), starts[first].tolist()):
                start -= begin[doc]
                best[doc, item] = (0, start, start + len(self.items[item]))
        return [(held[doc], item, start, distance, end)
                for (doc, item), (distance, start, end) in sorted(best.items())]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """Items in blocks of about BLOCK_ITEMS; only one block is held at a time."""
    rows = benchmark.select("item_id", "text").where("text is not null")
    blocks = max(1, -(-rows.count() // BLOCK_ITEMS))
    for b in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield sorted(((r[0], r[1]) for r in own.collect()), key=repr)


def found_in(search: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = search.matches(batch.column("text").to_pylist())
            size = [len(search.items[g[1]]) for g in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array([g[0] for g in got], pa.int64())),
                 pa.array([search.keys[g[1]] for g in got], item_type(search)),
                 *(pa.array([g[k] for g in got], pa.int64()) for k in (2, 4, 3)),
                 pa.array([1 - g[3] / n for g, n in zip(got, size)], pa.float64())],
                ["doc_id", "item_id", "first_word", "end_word", "edits", "similarity"])
    return run


def item_type(search: Search) -> pa.DataType:
    return pa.string() if any(isinstance(k, str) for k in search.keys) else pa.int64()


def contaminated(docs: DataFrame, benchmark: DataFrame, most_edits: float = MOST_EDITS) -> DataFrame:
    """(doc_id, item_id, first_word, end_word, edits, similarity): the best
    stretch of each text for each item found in it."""
    kind, item = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    item = item if item == "string" else "long"
    schema = (f"doc_id {kind}, item_id {item}, first_word long, end_word long, edits long,"
              " similarity double")
    out = None
    for items in item_blocks(benchmark):
        part = docs.select("doc_id", "text").mapInArrow(
            found_in(Search(items, most_edits)), schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean_rows(docs: DataFrame, benchmark: DataFrame, most_edits: float = MOST_EDITS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item."""
    def run(search: Search):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                bad = {g[0] for g in search.matches(texts)}
                yield batch.filter(pa.array([i not in bad for i in range(len(texts))], pa.bool_()))
        return keep

    for items in item_blocks(benchmark):
        docs = docs.mapInArrow(run(Search(items, most_edits)), docs.schema)
    return docs
