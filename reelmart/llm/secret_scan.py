"""Secret scans: a random forest removes false positives from candidates.

Candidates are words of twelve characters or more with a digit, whatever is
assigned to a credential name, short or without digits, and headers of private
keys. Features are
the candidate's length, its character classes and transitions between them, how
much of it dictionary words cover, signs of a path, address or url, and the
neighbouring words. The forest learns from labelled findings and then judges
every candidate; its verdict, not the labels, is the result.

Labelled findings come from the texts themselves (:func:`label`): tokens in a
provider's fixed format, or assigned to a credential name and random-looking,
are secrets; addresses, numbers, dates, UUIDs, urls and words with digits are
not; all other candidates are unlabelled. Formats are no features, so the
forest generalises beyond them. Training takes about ``TRAIN`` findings of each
kind at most, by hash, from documents whose crc32(doc_id) mod 4 is not 2.

All work is DataFrame expressions and Spark's own forest; no Python on
executors. The dictionary is counted over all documents: a word counts once a
document, words with digits (and so the candidates' own letters) not at all,
and it must stand in many unlike texts, by a rate that doesn't depend on the
size of the table. One row a word then meets the letter runs of candidates.

Defined cases: null and empty texts have no candidate; without labelled
findings of both kinds there is nothing to learn from and a candidate counts as
a secret if it is labelled one; a null doc_id is not learned from; repeated
rows give repeated findings; ties in the training sample go by value; very long
texts are split whole, a long word is one candidate; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm.common import cut, text_key, uniform

SPACE = "[\\x20\\x09-\\x0D]+"
SHORTEST = 12
TRAIN = 10_000
#: a value assigned to a credential name has so many characters at least
SHORTEST_NAMED = 4
#: a dictionary word stands in so many of a million documents, and fills so many
#: of 64 slots by the hash of the texts (copies of one text fill one)
DICTIONARY_RATE = 20
DICTIONARY_SPREAD = 12
TREES, DEEP, SEED = 30, 6, 11
#: fixed values: names that credentials are assigned to, and providers' formats
NAMES = "(?i)(password|passwd|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|auth|bearer|credential)"
FORMATS = ("^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
           "|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{20,}|PRIVATE KEY)$")
FEATURES = ["length", "digits", "uppers", "lowers", "others", "transitions", "turns", "distinct",
            "dictionary", "path", "address", "assigned", "named", "prev_letters", "next_letters"]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, word_no, word, prev2, prev, next) of each long word with a digit,
    of what is assigned to a credential name, and of private keys' headers."""
    words = docs.where("text is not null").select("doc_id", F.split("text", SPACE).alias("ws"))

    def near(i: Column, by: int) -> Column:
        return F.coalesce(F.get(F.col("ws"), i + by), F.lit(""))

    def keep(x: Column, i: Column) -> Column:
        prev = near(i, -1)
        header = x.rlike("^KEY-+") & (prev == "PRIVATE")
        named = (x.rlike(NAMES + f"[\"'`]?[=:][\"'`]?[^\"'`]{{{SHORTEST_NAMED},}}") | (F.length(x) >= SHORTEST_NAMED) & (
            prev.rlike(NAMES + "[\"'`]?[=:]$") | prev.isin("=", ":") & near(i, -2).rlike(NAMES)))
        return F.when(header | named | (F.length(x) >= SHORTEST) & x.rlike("[0-9]"), F.struct(
            i.alias("word_no"), F.when(header, F.concat(prev, F.lit(" "), x)).otherwise(x).alias("word"),
            near(i, -2).alias("prev2"), prev.alias("prev"), near(i, 1).alias("next")))

    hits = words.select("doc_id", F.explode(F.filter(
        F.transform("ws", keep), lambda h: h.isNotNull())).alias("h"))
    return hits.select("doc_id", "h.*")


def parted(found: DataFrame) -> DataFrame:
    """Candidates with the name before an ``=`` or ``:`` parted from the value."""
    core = F.regexp_replace("word", "^[^A-Za-z0-9]+|[^A-Za-z0-9=]+$", "")
    split = "^([A-Za-z][A-Za-z0-9_.-]*)[=:][\"'`]?(?!//)(.{4,})$"
    return (found.withColumn("core", core)
            .withColumn("name", F.regexp_extract("core", split, 1))
            .withColumn("value", F.when(F.col("name") != "", F.regexp_extract("core", split, 2))
                        .otherwise(F.col("core")))
            .withColumn("named", (F.col("name").rlike(NAMES) | F.col("prev").rlike(NAMES)
                                  | (F.col("prev").isin("=", ":") & F.col("prev2").rlike(NAMES)))
                        .cast("double"))
            .withColumn("assigned", ((F.col("name") != "") | F.col("prev").rlike("[=:]$")).cast("double"))
            .where(F.length("value") >= F.when(F.col("named") == 1, SHORTEST_NAMED).otherwise(8)))


def dictionary(docs: DataFrame) -> DataFrame:
    """(run): the words of many documents, counted before they meet anything."""
    plain = F.filter(F.split(F.lower("text"), SPACE), lambda x: ~x.rlike("[0-9]"))
    words = F.array_distinct(F.flatten(F.transform(plain, lambda x: F.split(x, "[^\\p{L}]+"))))
    slot = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(text_key(), F.lit(64)).cast("int"))
    each = docs.where("text is not null").select(slot.alias("slot"), F.explode(words).alias("run"))
    counted = each.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.bit_or("slot").alias("slots"))
    return counted.where((F.length("run") >= 3) & (F.bit_count("slots") >= DICTIONARY_SPREAD)
                         & (F.col("n") * 1_000_000 >= DICTIONARY_RATE * docs.count())).select("run")


def coverage(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(value, dictionary): share of the value inside letter runs of three or
    more that are dictionary words."""
    values = cut(found.select("value").distinct())
    runs = values.select("value", F.explode(F.regexp_extract_all(
        F.lower("value"), F.lit("([a-z]{3,})"), F.lit(1))).alias("run"))
    covered = runs.join(dictionary(docs), "run").groupBy("value").agg(
        (F.sum(F.length("run")) / F.first(F.length("value"))).alias("dictionary"))
    return values.join(covered, "value", "left").select(
        "value", F.coalesce("dictionary", F.lit(0.0)).alias("dictionary"))


def featured(docs: DataFrame) -> DataFrame:
    found = cut(parted(candidates(docs)))
    size = F.length("value").cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count("value", F.lit(pattern)) / size

    classes = ["0-9", "A-Z", "a-z"]
    change = "|".join(f"(?<=[{a}])(?=[{b}])" for a in classes for b in classes if a != b)
    turn = "(?i)(?=[aeiou][b-df-hj-np-tv-z]|[b-df-hj-np-tv-z][aeiou])"
    cover = coverage(found, docs)
    return cut(found.join(cover, "value").select(
        "doc_id", "word_no", "name", "value", "core", "prev", "named", "assigned", "dictionary",
        size.alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"),
        share("[a-z]").alias("lowers"), share("[^0-9A-Za-z]").alias("others"),
        share(change).alias("transitions"), share(turn).alias("turns"),
        (F.size(F.array_distinct(F.split("value", ""))) / size).alias("distinct"),
        F.col("core").rlike("/|\\\\|\\.[a-z]{2,4}$").cast("double").alias("path"),
        F.col("core").rlike("@|://|^[0-9.:/-]+$").cast("double").alias("address"),
        F.col("prev").rlike("^\\p{L}+[.,]?$").cast("double").alias("prev_letters"),
        F.col("next").rlike("^\\p{L}+[.,]?$").cast("double").alias("next_letters")))


def label() -> Column:
    """1.0 for sure secrets, 0.0 for sure non-secrets, null for the rest."""
    value, core = F.col("value"), F.col("core")
    random = value.rlike("^[0-9A-Fa-f]{16,}$") | (value.rlike("[0-9]") & value.rlike("[A-Z]")
                                                  & value.rlike("[a-z]") & (F.length(value) >= 16))
    harmless = (core.rlike("@[A-Za-z0-9.-]+\\.[a-z]+") | core.rlike("://") | core.rlike("^[0-9][0-9.,:/() -]*$")
                | core.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
                | core.rlike("^[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}$") & ~core.rlike("^AKIA")
                | ((F.col("dictionary") > 0.6) & (F.col("named") == 0)))
    return (F.when(value.rlike(FORMATS) | ((F.col("named") == 1) & (F.col("assigned") == 1) & random), 1.0)
            .when(harmless, 0.0))


def trained(rows: DataFrame):
    """The forest, or None if not both kinds are labelled."""
    known = rows.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()
                       & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    each = known.groupBy("label", *FEATURES).agg(F.min("value").alias("value"))
    sizes = {r["label"]: r["count"] for r in each.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1.0, min(1.0, TRAIN / sizes.get(1.0, 1))).otherwise(
        min(1.0, TRAIN / sizes.get(0.0, 1)))
    # one small partition in a fixed order, so that every run grows the same trees
    sample = cut(each.where(uniform(F.col("value")) < share)
                 .orderBy("label", "value", *FEATURES).coalesce(1))
    if len(sizes) < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(sample)
    return RandomForestClassifier(labelCol="label", featuresCol="_features", numTrees=TREES,
                                  maxDepth=DEEP, seed=SEED).fit(vectors)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, word_no, name, preview, sha256, label, probability, secret):
    every candidate of every text. Values are shown by four characters and hash."""
    rows = featured(docs).withColumn("label", label())
    forest = trained(rows)
    if forest is None:
        judged = rows.withColumn("probability", F.coalesce("label", F.lit(0.0)))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
        judged = forest.setProbabilityCol("_p").transform(vectors).withColumn(
            "probability", vector_to_array("_p")[1])
    return judged.select(
        "doc_id", F.col("word_no").cast("long").alias("word_no"), "name",
        F.substring("value", 1, 4).alias("preview"), F.sha2("value", 256).alias("sha256"), "label",
        "probability", (F.col("probability") >= 0.5).alias("secret"))
