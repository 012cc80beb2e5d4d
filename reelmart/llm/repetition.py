"""Quality rules by repetition coverage.

Words of a text get ids; rolling hashes over several n-gram lengths, in numpy
over many documents at once, tell which n-grams come again in the same text.
The characters of all words inside such n-grams, and of repeated lines, are
measured against the characters of all words. A document goes if one of these
shares is over its limit, or if the base rules fail.

The work is a map over whole texts; nothing is shuffled.

Defined cases: null, empty and blank texts have no words and fail the base
rules; a text of fewer words than an n-gram has none of that length; repeated
rows and equal doc_ids are judged row by row; there are no ties to break; very
long texts are measured whole, one at a time; null doc_id stays null; an empty
table gives an empty result; other columns are not looked at (``kept_rows``
carries them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from reelmart.llm.common import slices

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 10
BASE_LENGTH = 5
BASE_PERCENT = 20
#: n-gram length -> share of characters allowed inside repeated n-grams; wide
#: enough that one short line met twice does not condemn a short clean text
DUPLICATE_LIMITS = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
LINE_LIMIT = 0.30
LINE_CHAR_LIMIT = 0.20
#: words measured together
BLOCK = 500_000
ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD1342543DE82EF95)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * ODD
    return x ^ (x >> np.uint64(29))


def covered(grams: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside n-grams (hash by start; 0: none starts here) met twice or more."""
    starts = np.flatnonzero(grams)
    twice = starts[pd.Series(grams[starts]).duplicated(keep=False).to_numpy()]
    edge = np.zeros(words + 1, np.int64)
    edge[twice] += 1
    np.add.at(edge, twice + n, -1)
    return np.cumsum(edge[:-1]) > 0


def lines_of(text: str) -> tuple[int, int, int, int]:
    """Lines with a word, repeated ones, and the word characters of both."""
    seen, lines, dup, chars, dup_chars = set(), 0, 0, 0, 0
    for line in text.split("\n"):
        if not line.strip(BLANKS):
            continue
        size = len(line) - sum(map(line.count, BLANKS))
        lines, chars = lines + 1, chars + size
        if line in seen:
            dup, dup_chars = dup + 1, dup_chars + size
        else:
            seen.add(line)
    return lines, dup, chars, dup_chars


def measure(texts: list[str | None]) -> pd.DataFrame:
    """Base counts and shares of whole texts, a row for each."""
    words = [t.encode("utf-8", "replace").split() if t else [] for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    out = pd.DataFrame({"n_words": n})
    plain = [t or "" for t in texts]
    out["word_chars"] = np.array([len(t) - sum(map(t.count, BLANKS)) for t in plain], np.int64)
    out["n_symbols"] = np.array([sum(map(t.count, SYMBOLS)) for t in plain], np.int64)
    lines = np.array([lines_of(t) for t in plain], np.int64).reshape(-1, 4)
    out["n_dup_lines"] = lines[:, 1]
    out["line_share"] = lines[:, 1] / np.maximum(lines[:, 0], 1)
    out["line_char_share"] = lines[:, 3] / np.maximum(lines[:, 2], 1)
    flat = [w for ws in words for w in ws]
    total = len(flat)
    doc = np.repeat(np.arange(len(texts)), n)
    begin = np.cumsum(n) - n
    left = np.repeat(begin + n, n) - np.arange(total)  # words from here to the text's end
    ids, _ = pd.factorize(np.array(flat + [None], object)[:-1]) if total else (np.zeros(0, int), 0)
    sizes = np.array([len(w) for w in flat], np.int64)
    if total and any(not t.isascii() for t in plain):
        sizes = np.array([len(w) if w.isascii() else len(w.decode()) for w in flat], np.int64)
    h = mixed(ids.astype(np.uint64) + np.uint64(1))
    salt = mixed(doc.astype(np.uint64) * BASE + np.uint64(17))
    roll, length = h.copy(), 1

    def by_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=len(texts))

    wanted = sorted({BASE_LENGTH, *DUPLICATE_LIMITS})
    for size in wanted:
        while length < size:  # roll[i] covers words i .. i + length - 1
            nxt = np.zeros_like(roll)
            nxt[:max(0, total - length)] = roll[:max(0, total - length)] * BASE + h[length:]
            roll, length = nxt, length + 1
        grams = np.where(left >= size, mixed(roll ^ salt) | np.uint64(1), np.uint64(0))
        inside = covered(grams, size, total)
        if size == BASE_LENGTH:
            out["n_repeat_words"] = by_text(inside).astype(np.int64)
        if size in DUPLICATE_LIMITS:
            out[f"share_{size}"] = by_text(inside * sizes) / np.maximum(out["word_chars"], 1)
    return out


def verdict(m: pd.DataFrame) -> pd.DataFrame:
    m["base_failed"] = ((m["n_words"] < MIN_WORDS)
                        | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"]))
    over = (m["line_share"] > LINE_LIMIT) | (m["line_char_share"] > LINE_CHAR_LIMIT)
    for size, limit in DUPLICATE_LIMITS.items():
        over |= m[f"share_{size}"] > limit
    m["kept"] = ~m["base_failed"] & ~over
    return m


def blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of texts of about BLOCK words (6 characters each) together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") // 6
        if size > BLOCK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept"]


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        for a, b in blocks(texts):
            m = verdict(measure(texts[a:b]))
            kinds = [pa.bool_() if c in ("base_failed", "kept") else pa.int64() for c in COLUMNS]
            arrays = [pa.array(m[c].to_numpy(), t) for c, t in zip(COLUMNS, kinds)]
            shares = [c for c in m if "share" in c]
            arrays += [pa.array(m[c].to_numpy(float), pa.float64()) for c in shares]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *arrays],
                                             ["doc_id", *COLUMNS, *shares])


def repetition_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and all shares of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    shares = ["line_share", "line_char_share", *[f"share_{n}" for n in sorted(DUPLICATE_LIMITS)]]
    fields = [f"doc_id {kind}", *[f"{c} {'boolean' if c in ('base_failed', 'kept') else 'long'}"
                                  for c in COLUMNS], *[f"{c} double" for c in shares]]
    return docs.select("doc_id", "text").mapInArrow(judged, ", ".join(fields))
