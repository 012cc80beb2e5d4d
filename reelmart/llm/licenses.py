"""License scans by conditional compression.

Candidate blocks are stretches of about a template's length around a word that
no notice of this template can lack, cut to the words that match it. Each block is
compressed on its own and with every template as zstandard raw dictionary; the
template that reduces the size most is the winner by rank. There is no least
reduction, as it would depend on the prose around. The winner is confirmed by
the exact wording: the block's best-matching words are compared with the
template's, word by word, and nothing that tells licenses apart (a number, a
name, ``NC``, ``Lesser``) may differ.

The work is a map over whole texts; nothing is shuffled. Lines don't matter: a
notice may be wrapped, and several may stand in one line. A row is given for
every notice; of overlapping ones only for that of most words.

Defined cases: null and blank texts have no block; a very long text is searched
in overlapping pieces; equal reductions are ranked by license
name; repeated rows each give their findings; null doc_id stays null; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import slices

#: fixed values: usual short notices of common licenses
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use"
     " this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
     " software and associated documentation files (the \"Software\"), to deal in the Software"
     " without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
#: words of templates that may differ: anything but these tells licenses apart
FILLER = set("a an and are as at by code copy file files form hereby in is it licensed license may"
             " of released source software subject terms the this to under use work".split())
#: what a text with a notice holds, for Spark; a notice may be wrapped anywhere
TRIGGER = ("(?i)licen[sc]e|permission[\\W_]+is[\\W_]+hereby|public[\\W_]+domain"
           "|creative[\\W_]+commons|\\bCC[\\W_]+BY")
TOKEN = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
#: words by which a notice's parts may be out of place
REACH = 3
#: most of a template's words that may differ
MOST_DIFFERING = 0.2
#: words of a text looked at together
PIECE = 50_000
LEVEL = 3


def pieces(text: str, overlap: int) -> Iterator[list[tuple[int, int]]]:
    """Spans of the words, ``PIECE`` at a time, each piece from ``overlap`` words
    before the last one's end on."""
    held: list[tuple[int, int]] = []
    for m in TOKEN.finditer(text):
        held.append(m.span())
        if len(held) >= PIECE + overlap:
            yield held
            held = held[-overlap:]
    yield held


def words(text: str) -> list[str]:
    return [w.lower() for w in TOKEN.findall(text)]


def differing(want: list[str], have: list[str]) -> tuple[list[str], list[str], int, int]:
    """(template words missing in the block, block words put between matched
    ones, first and last + 1 word of the stretch that matches)."""
    same = difflib.SequenceMatcher(None, want, have, autojunk=False)
    parts = [m for m in same.get_matching_blocks() if m.size]
    if not parts:
        return want, [], 0, 0
    # the densest stretch: begins and ends with the longest part and its neighbours in reach
    main = max(parts, key=lambda m: m.size)
    low, high = main.b - main.a - REACH, main.b - main.a + len(want) + REACH
    parts = [m for m in parts if low <= m.b and m.b + m.size <= high]
    hit = {i for m in parts for i in range(m.a, m.a + m.size)}
    missing = [w for i, w in enumerate(want) if i not in hit]
    inserted = [w for m, n in zip(parts, parts[1:]) for w in have[m.b + m.size:n.b]]
    return missing, inserted, parts[0].b, parts[-1].b + parts[-1].size


def confirmed(want: list[str], have: list[str]) -> tuple[int, int, int] | None:
    """(words differing, first, last + 1 word) if the wording is the template's."""
    missing, inserted, first, last = differing(want, have)
    if (len(missing) + len(inserted) > MOST_DIFFERING * len(want)
            or any(w not in FILLER for w in (*missing, *inserted))):
        return None
    return len(missing) + len(inserted), first, last


class Scanner:
    def __init__(self, templates):
        self.templates = sorted(templates)
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.with_dict = [zstandard.ZstdCompressor(
            level=LEVEL, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
                text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for _, text in self.templates]
        self.look = lru_cache(maxsize=20_000)(self._look)
        self.want = [words(text) for _, text in self.templates]
        self.longest = max(map(len, self.want), default=0)
        #: words that a confirmed notice can't lack
        self.needed = [{w for w in want if w not in FILLER} for want in self.want]
        #: word -> templates of which a notice must hold it, and its place there
        self.anchors: dict[str, list[tuple[int, int]]] = {}
        for t, want in enumerate(self.want):
            sure = [k for k, w in enumerate(want) if w not in FILLER][:1]
            for k in sure or range(min(len(want), int(MOST_DIFFERING * len(want)) + 1)):
                self.anchors.setdefault(want[k], []).append((t, k))

    def _look(self, block: str) -> tuple | None:
        """The best confirmed (license, reduction, runner-up, its reduction, words differing)."""
        raw, have = block.encode("utf-8", "replace"), words(block)
        alone = len(self.plain.compress(raw))
        ranked = sorted(((1 - len(c.compress(raw)) / alone, name, t) for t, (c, (name, _)) in enumerate(
            zip(self.with_dict, self.templates))), key=lambda x: (-x[0], *x[1:]))
        for gain, name, t in ranked:
            if self.needed[t] <= set(have) and (got := confirmed(self.want[t], have)):
                other = next((r for r in ranked if r[1] != name), (0.0, None, None))
                return name, gain, other[1], other[0], got[0]
        return None

    def notices(self, text: str) -> list[tuple]:
        """(first character, block, *look) of each notice, in the text's order."""
        found: set[tuple[int, int, int]] = set()
        for spans in pieces(text, 2 * (self.longest + 2 * REACH)):
            have = [text[a:b].lower() for a, b in spans]
            for at, word in enumerate(have):
                for t, k in self.anchors.get(word, ()):
                    low = max(0, at - k - 2 * REACH)
                    near = have[low:at - k + len(self.want[t]) + 2 * REACH]
                    if self.needed[t].issubset(near) and (got := confirmed(self.want[t], near)):
                        _, first, last = got
                        found.add((first - last, spans[low + first][0], spans[low + last - 1][1]))
        out: list[tuple] = []
        taken: list[tuple[int, int]] = []
        for _, a, b in sorted(found):  # of overlapping stretches the one of most words
            if all(b <= c or d <= a for c, d in taken) and (got := self.look(text[a:b])):
                taken.append((a, b))
                out.append((a, text[a:b], *got))
        return sorted(out)


def scan_batches(templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in slices(batches):
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                rows += [(i, *got) for got in scanner.notices(text)]
            cols = list(zip(*rows)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string()),
                 pa.array(cols[4], pa.float64()), pa.array(cols[5], pa.string()),
                 pa.array(cols[6], pa.float64()), pa.array(cols[7], pa.int64())],
                ["doc_id", "char_start", "block", "license", "reduction", "runner_up",
                 "runner_up_reduction", "words_differing"])
    return run


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """A row for each notice of each text in which a license was confirmed."""
    kind = dict(docs.dtypes)["doc_id"]
    marked = docs.select("doc_id", "text").where(F.col("text").rlike(TRIGGER))
    return marked.mapInArrow(scan_batches(templates), (
        f"doc_id {kind}, char_start long, block string, license string, reduction double,"
        " runner_up string, runner_up_reduction double, words_differing long"))
