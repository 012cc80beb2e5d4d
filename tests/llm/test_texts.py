import collections
import itertools
import math
import random
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmart.llm import decontaminate, language, licenses, repetition, secret_scan, url_rules
from tests.conftest import SF_MID

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


# URL rules --------------------------------------------------------------------
def brute_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v == "block", len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_url_rules(spark):
    rng = random.Random(4)
    labels = ["a", "b", "net", "example", "xn--é"]
    rules = {(".".join(rng.choices(labels, k=rng.randint(1, 3))), rng.choice(["/", "/p/", "/p/q", ""])):
             rng.choice(["allow", "block"]) for _ in range(25)}
    rules = [(v, h, p) for (h, p), v in rules.items()]
    urls = ["http://" + ".".join(rng.choices(labels + ["B", "A"], k=rng.randint(1, 4)))
            + rng.choice(["", "/", "/p/x", "/p/q?r=/p", "#f", "?q", "/P/"]) for _ in range(600)]
    urls += [None, "", "no scheme", "://", "http://", "x://NET/p/q", "http://a.net:80/p/"] + [urls[0]] * 300
    pages = spark.createDataFrame([(i if i % 50 else None, u, "block", 1) for i, u in enumerate(urls)],
                                  "page_id long, url string, verdict string, part int").repartition(5)
    got = sorted((tuple(r) for r in url_rules.judge(pages, url_rules.rules_frame(spark, rules)).collect()), key=repr)
    assert got == sorted(((i if i % 50 else None, *brute_judge(u, rules)) for i, u in enumerate(urls)), key=repr)
    assert url_rules.judge(pages.limit(0), url_rules.rules_frame(spark)).count() == 0


def test_url_rules_on_all_planes_and_many_equal_rows(spark):
    """Hosts beyond U+FFFF near many splitters, and a third of the rows alike."""
    rng = random.Random(6)
    signs = ["a", "z", "~", "é", "漢", "\ue000", "\uffff", "😀", "\U0010fffd"]
    urls = [f"https://{rng.choice(signs)}{rng.choice(signs)}{i}.{rng.choice(['net', 'example.net', 'com', '😀.org'])}"
            f"{rng.choice(['/', '/x', '/en/', '/fr/é😀'])}" for i in range(3000)]
    urls += ["https://\uffff.net/one"] * 1500
    rules = url_rules.RULES + [("block", "😀.org", "/"), ("allow", "\uffff.net", "/one")]
    pages = spark.createDataFrame([(None if i % 7 == 0 else i, u) for i, u in enumerate(urls)],
                                  "page_id long, url string").repartition(6)
    got = sorted((tuple(r) for r in url_rules.judge(pages, url_rules.rules_frame(spark, rules)).collect()), key=repr)
    assert got == sorted(((None if i % 7 == 0 else i, *brute_judge(u, rules)) for i, u in enumerate(urls)), key=repr)


def test_splitters_are_found_in_two_steps(spark):
    marks = sorted(["b"] * 5 + ["a", "c", "d", "dd", "é", "😀"] + [f"m{i:02}" for i in range(30)])
    keys = ["", "a", "aa", "b", "d", "m07", "m29", "zzz", "é", "\uffff", "😀", "😀z"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select(
        "k", *[url_rules.parts_of(marks, F.col("k"), upto).alias(f"p{upto}") for upto in (False, True)]).collect()
    assert [tuple(r) for r in rows] == [(k, sum(m < k for m in marks), sum(m <= k for m in marks)) for k in keys]
    assert url_rules.parts_of([], F.col("k"), True) is not None


# repetition -------------------------------------------------------------------
def brute_repetition(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = [x for i, x in enumerate(lines) if x in lines[:i]] if len(lines) < 500 else None

    def inside(n):
        count = collections.Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        hit = set()
        for i in range(len(words) - n + 1):
            if count[tuple(words[i:i + n])] > 1:
                hit |= set(range(i, i + n))
        return hit

    chars = sum(map(len, words))
    shares = {n: sum(len(words[i]) for i in inside(n)) / max(1, chars) for n in repetition.DUPLICATE_LIMITS}
    repeat = len(inside(5))
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    line_share = len(dup) / max(1, len(lines))
    line_chars = sum(sum(map(len, WORD.findall(x))) for x in dup) / max(1, chars)
    bad = (line_share > repetition.LINE_LIMIT or line_chars > repetition.LINE_CHAR_LIMIT
           or any(shares[n] > limit for n, limit in repetition.DUPLICATE_LIMITS.items()))
    return (len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), len(dup), repeat, failed,
            not failed and not bad, {n: round(s, 9) for n, s in shares.items()})


def test_repetition_equals_brute_force(odd, small):
    for frame in (odd, small):
        texts = collections.defaultdict(list)
        for r in frame.select("doc_id", "text").collect():
            texts[r["doc_id"]].append(r["text"])
        for r in repetition.repetition_rules(frame).collect():
            want = brute_repetition(texts[r["doc_id"]][0])
            got = (*[r[c] for c in repetition.COLUMNS],
                   {n: round(r[f"share_{n}"], 9) for n in repetition.DUPLICATE_LIMITS})
            assert got == want, r["doc_id"]


# licenses ---------------------------------------------------------------------
def test_license_wording_decides(spark):
    cases = {
        "Released under the MIT License.": "MIT", "released under MIT license": "MIT",
        "x\nLicensed under CC BY-NC 4.0.\ny": "CC-BY-NC-4.0", "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "pad " * 5000 + "Licensed under the Apache License, Version 2.0. " + "pad " * 5000: "Apache-2.0",
        "He lost his driving license in 2.0 days.": None, "the license of the MIT building": None,
        "Licensed under the Apache License, Version 1.1.": None, None: None, "": None}
    docs = spark.createDataFrame([(i, t, "MIT") for i, t in enumerate(cases)], "doc_id long, text string, license string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(docs).collect()}
    assert [got.get(i) for i in range(len(cases))] == list(cases.values())


def test_all_license_lines_are_found(small, odd, empty):
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = {(r["doc_id"], name) for r in small.collect() for line, name in lines.items() if line in (r["text"] or "")}
    assert {(r["doc_id"], r["license"]) for r in licenses.scan(small).collect()} == want
    assert licenses.scan(odd).count() >= 0 and licenses.scan(empty).count() == 0


PROSE = ("The morning boat had left before anyone noticed that the parcel was still lying on the bench. "
         "Later in the week the clerk asked for the key, wrote a line in the book and walked home along the river. ")


def test_license_inside_ordinary_prose(spark):
    rows = [(i, PROSE * 2 + text + " " + PROSE * 2, name) for i, (name, text) in enumerate(licenses.TEMPLATES)]
    rows += [(100, PROSE * 2 + "She lost her license in " + PROSE * 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    got = {r["doc_id"]: (r["license"], r["char_start"]) for r in licenses.scan(docs).collect()}
    assert {i: name for i, (name, _) in got.items()} == {i: name for i, _, name in rows if name}
    assert all(at == len(PROSE * 2) for _, at in got.values())


def test_wrapped_and_neighbouring_licenses(spark, monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 70)
    rows = []
    for i, (name, text) in enumerate(licenses.TEMPLATES):
        for k, (width, sign) in enumerate([(30, "# "), (75, " * "), (12, "")]):
            wrapped = textwrap.fill(text, width, initial_indent=sign, subsequent_indent=sign,
                                    break_long_words=False, break_on_hyphens=False)
            rows.append((3 * i + k, PROSE * 2 + "\n" + wrapped + "\n" + PROSE * 2, [name]))
    both = [("Released under the MIT License.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
            ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Released under the MIT License.", "MIT")]
    rows += [(900, " ".join(t for t, _ in both), [n for _, n in both])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, names array<string>")
    got = collections.defaultdict(list)
    for r in licenses.scan(docs).orderBy("doc_id", "char_start").collect():
        got[r["doc_id"]].append(r["license"])
        assert rows[min(r["doc_id"], len(rows) - 1)][1][r["char_start"]:].startswith(r["block"])
    assert got == {i: names for i, _, names in rows}


# language ---------------------------------------------------------------------
def test_forward_sums_all_segmentations():
    pieces = {p: i for i, p in enumerate([b" ", b"a", b"b", b"ab", b" a", b"ba", b"aba"])}
    prob = np.random.default_rng(3).dirichlet(np.ones(len(pieces)), 2)
    words = [b"abab", b"b", b"aaa"]
    lattice = language.Lattice(words, pieces)
    got = lattice.total(lattice.forward(prob))
    for k, w in enumerate(words):
        w = b" " + w
        for lang in range(2):
            total, used = 0.0, np.zeros(len(pieces))
            for cuts in itertools.product([0, 1], repeat=len(w) - 1):
                at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(w)]
                parts = [w[a:b] for a, b in zip(at, at[1:])]
                if all(p in pieces for p in parts):
                    one = math.prod(prob[lang, pieces[p]] for p in parts)
                    total += one
                    for p in parts:
                        used[pieces[p]] += one
            assert got[k, lang] == pytest.approx(total)
            one = language.Lattice([words[k]], pieces).expected(prob[lang], np.array([2.0]))
            assert one == pytest.approx(2 * used / total)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = {r["doc_id"]: r for r in language.language_id(docs).collect()}
    held = [r for r in docs.collect() if got[r["doc_id"]]["held_out"] and r["lang"]]
    assert len(held) > 100
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_cases(odd, empty):
    rows = language.language_id(odd).collect()
    assert len(rows) == odd.count()
    said = {r["doc_id"]: r for r in rows}
    assert all(said[i]["lang_pred"] == "und" and said[i]["score"] == 0 for i in (9000, 9001, 9002, 9006))
    assert said[9004]["lang_pred"] != "und" and said[None]["held_out"] is False
    assert language.language_id(empty).count() == 0


def test_language_of_long_unseen_words_is_no_tie():
    """Thirty-one unseen bytes, each far less likely in one language: no floor."""
    pieces = {bytes([b]): b for b in range(256)} | {b"ab": 256}
    prob = np.full((2, 257), 1e-11)
    prob[1] *= 1e-3
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "held_out": [True, True],
                                        "text": ["q" * 31 + " z", ("é" * 15 + " ") * 40]})
    out = next(language.scorer(["a", "b"], prob, pieces)(iter([batch])))
    assert out.column("lang_pred").to_pylist() == ["a", "a"] and min(out.column("score").to_pylist()) > 0.99
    one = language.scorer(["b", "a"], prob[::-1], pieces)
    assert next(one(iter([batch]))).column("lang_pred").to_pylist() == ["a", "a"]


def test_three_hundred_languages(spark):
    """Each language has words of its own; none is left out."""
    rng = random.Random(7)
    docs = []
    for k in range(300):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)]
        docs += [(k * 10 + j, " ".join(rng.choices(words, k=12)), f"l{k:03}") for j in range(8)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in language.language_id(frame).collect()}
    held = [(d, lang) for d, _, lang in docs if got[d]["held_out"]]
    assert len(held) > 400 and sum(got[d]["lang_pred"] == lang for d, lang in held) / len(held) >= 0.97


# decontamination --------------------------------------------------------------
def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.choice("sid")
        if kind == "s":
            words[at] = rng.choice(vocabulary)
        elif kind == "i":
            words.insert(at, rng.choice(vocabulary))
        elif len(words) > 1:
            del words[at]
    return words


def distance(a, b):
    """Least edits from ``a`` to any stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet(f"{SF_MID}/benchmark.parquet")


def test_decontamination_recall_and_distance(small, bench):
    items = [tuple(r) for r in bench.select("item_id", "text").orderBy("item_id").collect()]
    texts = [r["text"] for r in small.collect()]
    vocabulary = sorted({w for t in texts[:80] for w in t.lower().split()})
    search, rng = decontaminate.Search(items), random.Random(8)
    planted = []
    for key, text in items * 4:
        words = [w.decode() for w in decontaminate.words_of(text)]
        host = rng.choice(texts).split()[:200]
        at = rng.randrange(len(host) + 1)
        inside = edited(rng, words, int(decontaminate.MOST_EDITS * len(words)), vocabulary)
        planted.append((key, " ".join(host[:at] + inside + host[at:])))
    got = search.matches([t for _, t in planted])
    found = {(g[0], search.keys[g[1]]) for g in got}
    assert sum((i, key) in found for i, (key, _) in enumerate(planted)) / len(planted) >= 0.97
    for g in got[:60]:
        item = dict(items)[search.keys[g[1]]]
        assert g[3] == distance(decontaminate.words_of(item), decontaminate.words_of(planted[g[0]][1]))


def test_decontamination_of_tables(spark, odd, small, bench, empty, monkeypatch):
    item = bench.where("item_id = 3").first()["text"]
    words = item.split()
    extra = spark.createDataFrame([(77_000, "before " + item + " after"), (77_001, " ".join(reversed(words))),
                                   (77_002, item.upper().replace(" ", "\n"))], "doc_id long, text string")
    docs = odd.select("doc_id", "text", "size", "key").unionByName(extra, allowMissingColumns=True)
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got if r["doc_id"] and r["doc_id"] >= 77_000} == {
        (77_000, 3, 0), (77_002, 3, 0)}
    clean = decontaminate.clean_rows(docs, bench)
    assert clean.columns == docs.columns
    bad = {r["doc_id"] for r in got}
    assert sorted(r["doc_id"] or 0 for r in clean.collect()) == sorted(
        r["doc_id"] or 0 for r in docs.collect() if r["doc_id"] not in bad)
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()), key=repr) == sorted(
        map(tuple, got), key=repr)
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, item), (5, None), (6, "too short")], "item_id long, text string")
    assert {r["item_id"] for r in decontaminate.contaminated(docs, nulls).collect()} == {None}


def test_short_items_and_scripts_without_spaces(spark):
    items = ["Photosynthesis", "the Blue Danube", "的中文句子没有空格也要能找到。", "日本", "ประเทศไทยสวยงาม", "«tête‑bêche»　naïve！café été hiver",
             "???", "Blue Danube"]
    texts = ["On photosynthesis, twice: photosynthesis.", "by the blue,　Danube river", "前面的中文句子没有空格也要能找到，后面",
             "the blue and the Danube", "ไปประเทศไทยสวยงามมาก", "une Tête bêche（Naïve）— Café; Été, hiver.", "???", "本日", "前面的中文句孑没有空格也要能找到，后面"]
    want = {(0, 0, 0, 1, 2), (1, 1, 0, 1, 4), (1, 7, 0, 2, 4), (2, 2, 0, 2, 16), (4, 4, 0, 2, 17), (5, 5, 0, 1, 7), (8, 2, 1, 2, 16)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["edits"], r["first_word"], r["end_word"])
           for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == want
    assert {r["doc_id"] for r in decontaminate.clean_rows(docs, bench).collect()} == {3, 6, 7}


# secrets ----------------------------------------------------------------------
def test_secret_scan(spark, odd, empty):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = secret_scan.scan(docs).where("crc32(cast(doc_id as string)) % 4 = 2 and label is not null").collect()
    assert len(got) >= 10 and len({r["label"] for r in got}) == 2
    assert sum(r["secret"] == (r["label"] == 1) for r in got) / len(got) >= 0.95
    rows = [r for r in odd.select("doc_id", "text").collect() if r["text"]]
    want = collections.Counter((r["doc_id"], i) for r in rows for i, w in enumerate(re.split("[\x20\x09-\x0D]+", r["text"]))
                               if len(w) >= 12 and re.search("[0-9]", w) and len(w.strip("().,;:'\"")) >= 8)
    odd_rows = collections.Counter((r["doc_id"], r["word_no"]) for r in secret_scan.scan(odd).collect())
    assert want <= odd_rows and secret_scan.scan(empty).count() == 0
    extra = spark.createDataFrame(
        [(500_000, 'and the token = "0123456789abcdef0123456789abcdef01234567" is here'),
         (500_001, "write to someone.42@mail7.example.com or see 123.123.123.123 now"),
         (500_002, 'her secret = "Zq8xW3bN7tR5yU1kP0mV" came')], "doc_id long, text string")
    judged = {r["doc_id"]: r["secret"] for r in secret_scan.scan(
        docs.select("doc_id", "text").unionByName(extra)).where("doc_id >= 500000").collect()}
    assert judged == {500_000: True, 500_001: False, 500_002: True}


def test_secret_candidates_of_any_length(spark):
    """Values after credential names, without digits or short; key headers."""
    texts = ["set password=correcthorsebatterystaple now", "pwd: S3cr3tPw! today", "the token = abcd1234 here",
             "-----BEGIN RSA PRIVATE KEY----- MIIE", "api_key='k' is short", "a password is a word", "secret: hunter"]
    docs = spark.createDataFrame([(i, t, "v", 1.0) for i, t in enumerate(texts)],
                                 "doc_id long, text string, value string, label double")
    got = {(r["doc_id"], r["value"]) for r in secret_scan.parted(secret_scan.candidates(docs)).collect()}
    assert got == {(0, "correcthorsebatterystaple"), (1, "S3cr3tPw"), (2, "abcd1234"), (3, "PRIVATE KEY"),
                   (6, "hunter")}
    rows = {r["doc_id"]: r["label"] for r in secret_scan.scan(docs).collect()}
    assert rows[3] == 1.0 and rows[0] is None  # a passphrase is not labelled: the forest judges it


def test_dictionary_and_coverage_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "DICTIONARY_SPREAD", 4)
    rng = random.Random(12)
    common = ["alpha", "beta", "gamma", "Delta", "straße"]
    docs = [" ".join(rng.choices(common, k=4)) + f" filler{i} x9alpha{i}key" for i in range(80)]
    docs += ["copied text with rareword and alpha only"] * 50 + ["rare1key" * 3, None, ""]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)
    got = {r["run"] for r in secret_scan.dictionary(frame).collect()}
    assert got == {w.lower() for w in common}  # not "rareword": fifty copies are one text
    found = spark.createDataFrame([("alphaXq1betagammaZZ",), ("rareword1key",), ("0011",), ("alpha1alpha1",)], "value string")
    cover = {r["value"]: r["dictionary"] for r in secret_scan.coverage(found, frame).collect()}

    def brute(value):
        return sum(len(x) for x in re.findall("[a-z]{3,}", value.lower()) if x in got) / len(value)
    assert cover == {v: brute(v) for v in cover} and cover["alpha1alpha1"] == 10 / 12
