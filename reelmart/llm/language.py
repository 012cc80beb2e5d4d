"""Language ID by unigrams over a fixed vocabulary, all segmentations summed.

The vocabulary is a public byte-level one; each language has its own piece
probabilities. A word (a run of letters, lower-cased, with a blank before it)
has many segmentations into pieces; its probability is the sum over all of
them, by a forward pass over its bytes. A text's score is the sum of its words'
log probabilities; the language with the largest wins.

Piece probabilities come from expectation-maximisation over the word counts of
a bounded sample of labelled texts (``TRAIN_DOCS`` a language, by hash of the
id): each round, a Spark job sums expected piece counts over the word table.
Scoring is a map over whole texts with the probabilities (vocabulary x
languages, both of known size) as closure.

Defined cases: text that is null or has no letter gets ``und`` and score 0; with
no labelled text at all, everything gets ``und``; a null doc_id is neither held
out nor learned from; a null lang is never learned; repeated rows are scored
each; letter runs of over 32 bytes are cut into parts of 32; other columns are
not looked at.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import cut, slices, uniform

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TRAIN_DOCS = 1000
#: languages learned, the most frequent first: probabilities are languages x vocabulary numbers
MOST_LANGUAGES = 1000
ROUNDS = 3
#: added to every piece's expected count
SMOOTH = 0.01
LONGEST_WORD = 32
LONGEST_PIECE = 16
#: scores (words x languages) that one worker keeps, and places x languages that it fills at a time
REMEMBERED = 12_000_000
AT_ONCE = 4_000_000
#: bits by which a byte's probability is raised, so that no word's is too small for a double
RAISED = 16
LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes other than letters part words; all other bytes stay
PARTS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def vocabulary(path: str) -> dict[bytes, int]:
    """Pieces of at most LONGEST_PIECE bytes, all 256 single bytes among them."""
    with open(path, "rb") as f:
        pieces = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    pieces |= {bytes([b]) for b in range(256)}
    return {p: i for i, p in enumerate(sorted(p for p in pieces if len(p) <= LONGEST_PIECE))}


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def words_of(text: str) -> list[bytes]:
    found = text.lower().encode("utf-8", "replace").translate(PARTS).split()
    if any(len(w) >= LONGEST_WORD for w in found):
        step = LONGEST_WORD - 1
        found = [w[i:i + step] for w in found for i in range(0, len(w), step)]
    return found


class Lattice:
    """All pieces at all places of a list of words, as arrays sorted by end."""

    def __init__(self, words: list[bytes], pieces: dict[bytes, int]):
        self.n = len(words)
        w, i, j, p = [], [], [], []
        for k, word in enumerate(words):
            word = b" " + word
            size = len(word)
            for a in range(size):
                for b in range(a + 1, min(size, a + LONGEST_PIECE) + 1):
                    got = pieces.get(word[a:b])
                    if got is not None:
                        w.append(k); i.append(a); j.append(b); p.append(got)
        self.word, self.start, self.end, self.piece = (np.array(x, np.int64) for x in (w, i, j, p))
        self.size = np.array([len(x) + 1 for x in words], np.int64)
        self.width = int(self.size.max(initial=1)) + 1

    def _pass(self, prob: np.ndarray, src: np.ndarray, dst: np.ndarray, first: np.ndarray,
              steps: range) -> np.ndarray:
        table = np.zeros((self.n, self.width, prob.shape[0]))
        table[np.arange(self.n), first] = 1.0
        order = np.argsort(dst, kind="stable")
        cuts = np.searchsorted(dst[order], np.arange(self.width + 1))
        for at in steps:
            e = order[cuts[at]:cuts[at + 1]]
            if not len(e):
                continue
            w = self.word[e]
            for lang in range(prob.shape[0]):
                add = table[w, src[e], lang] * prob[lang, self.piece[e]]
                table[:, at, lang] += np.bincount(w, weights=add, minlength=self.n)
        return table

    def forward(self, prob: np.ndarray) -> np.ndarray:
        zero = np.zeros(self.n, np.int64)
        return self._pass(prob, self.start, self.end, zero, range(1, self.width))

    def total(self, table: np.ndarray) -> np.ndarray:
        return table[np.arange(self.n), self.size]

    def expected(self, prob: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected count of each piece, words weighted by ``times`` (one language)."""
        p = prob[None, :]
        ahead = self.forward(p)
        back = self._pass(p, self.end, self.start, self.size, range(self.width - 1, -1, -1))
        z = self.total(ahead)[:, 0]
        share = (ahead[self.word, self.start, 0] * prob[self.piece]
                 * back[self.word, self.end, 0] / z[self.word])
        return np.bincount(self.piece, weights=share * times[self.word], minlength=len(prob))


def word_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        counts: dict[tuple[str, bytes], int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for w in words_of(text):
                counts[lang, w] = counts.get((lang, w), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.binary()),
             pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])


def train(docs: DataFrame, path: str, per_language: int = TRAIN_DOCS, rounds: int = ROUNDS
          ) -> tuple[list[str], np.ndarray]:
    """(languages, log-free piece probabilities, languages x pieces)."""
    pieces = vocabulary(path)
    known = docs.select("doc_id", "lang", "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    if not sizes:
        return [], np.zeros((0, len(pieces)))
    langs = sorted(sizes)
    share = F.element_at(F.create_map(*[x for lang in langs for x in (
        F.lit(lang), F.lit(min(1.0, per_language / sizes[lang])))]), F.col("lang"))
    sample = known.where(F.col("lang").isin(langs) & (uniform(F.col("doc_id")) < share))
    words = cut(sample.select("lang", "text").mapInArrow(word_table, "lang string, word binary, n long")
                .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    prob = np.full((len(langs), len(pieces)), 1.0 / len(pieces))
    for _ in range(rounds):
        prob = maximised(words, langs, pieces, prob)
    return langs, prob


def maximised(words: DataFrame, langs: list[str], pieces: dict[bytes, int], prob: np.ndarray
              ) -> np.ndarray:
    """One round: expected piece counts by Spark, normalised on the driver
    (languages x vocabulary numbers, whatever the text)."""
    index = {lang: i for i, lang in enumerate(langs)}

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros(prob.shape)
        for batch in batches:
            frame = batch.to_pandas()
            for lang, part in frame.groupby("lang", sort=True):
                for a in range(0, len(part), 5000):
                    few = part.iloc[a:a + 5000]
                    lattice = Lattice(list(few["word"]), pieces)
                    got[index[lang]] += lattice.expected(prob[index[lang]], few["n"].to_numpy(float))
        lang, piece = np.nonzero(got)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(piece), pa.array(np.round(got[lang, piece], 6))],
            ["lang", "piece", "n"])

    summed = words.mapInArrow(expect, "lang long, piece long, n double").groupBy("lang", "piece").agg(
        F.sum(F.col("n").cast("decimal(28,6)")).cast("double").alias("n")).toPandas()
    new = np.full(prob.shape, SMOOTH)
    new[summed["lang"].to_numpy(int), summed["piece"].to_numpy(int)] += summed["n"].to_numpy(float)
    return new / new.sum(axis=1, keepdims=True)


def scorer(langs: list[str], prob: np.ndarray, pieces: dict[bytes, int]):
    """Map over batches: language and posterior of whole texts."""

    size = np.array([len(p) for p in pieces])
    raised = prob * 2.0 ** (RAISED * size)
    few = max(1, AT_ONCE // ((LONGEST_WORD + 2) * len(langs)))

    def log_probability(words: list[bytes]) -> np.ndarray:
        lattice = Lattice(words, pieces)
        total = np.maximum(lattice.total(lattice.forward(raised)), 1e-300)
        return np.log(total) - lattice.size[:, None] * (RAISED * np.log(2.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        scores = np.zeros((0, len(langs)))
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            said, sure = [], np.zeros(len(texts))
            for a in range(0, len(texts), 256):
                found = [words_of(t) if t and LETTER.search(t) else [] for t in texts[a:a + 256]]
                flat = [w for ws in found for w in ws]
                codes, unique = pd.factorize(np.array([*flat, None], object)[:-1])
                if len(known) * len(langs) > REMEMBERED:
                    known, scores = {}, scores[:0]
                new = [w for w in unique if w not in known]
                if new:
                    z = [log_probability(new[b:b + few]) for b in range(0, len(new), few)]
                    known.update(zip(new, range(len(scores), len(scores) + len(new))))
                    scores = np.concatenate([scores, *z])
                rows = np.array([known[w] for w in unique], np.int64)
                n = np.array([len(ws) for ws in found])
                doc = np.repeat(np.arange(len(found)), n)
                each = scores[rows[codes]] if len(flat) else np.zeros((0, len(langs)))
                total = np.stack([np.bincount(doc, weights=each[:, k], minlength=len(found))
                                  for k in range(len(langs))], axis=1)
                best = total.argmax(axis=1)
                odds = np.exp(total - total.max(axis=1, keepdims=True))
                sure[a:a + 256] = np.where(n > 0, odds.max(axis=1) / odds.sum(axis=1), 0.0)
                said += [langs[k] if c else "und" for k, c in zip(best, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(said, pa.string()),
                 pa.array(sure)], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, langs: list[str], prob: np.ndarray, path: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    if not langs:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(scorer(langs, prob, vocabulary(path)),
                           f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, path: str | None = None) -> DataFrame:
    path = path or vocabulary_path()
    langs, prob = train(docs.where(~held_out()), path)
    return identify(docs, langs, prob, path)
