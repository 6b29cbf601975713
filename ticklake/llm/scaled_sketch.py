"""Document fingerprints with built-in functions only: sketches scaled by a threshold.

A sketch keeps every shingle hash below a fixed fraction of all hashes, so its size follows the text and two sketches of very
unequal texts still estimate how much of the one stands in the other. Texts of up to ``WHOLE`` shingles keep them all; such a sketch
compares with a sampled one by its hashes below the fraction. Sketches merge: the sketch of a union of texts is the union of their
sketches (at the fraction, unless all are whole).

Shingles are five words ``[^\\x20\\x09-\\x0D]+``; a shorter text that has words is one shingle. Hashes are the first 16 hexadecimal digits of the MD5 of the
words joined by one space; they are kept as text, so that the fraction is a bound on their first digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import settle

SHINGLE_WORDS = 5
#: one of SCALE hashes is kept: those below BOUND
SCALE, BOUND = 8, "2"
#: shingles, repeats included, up to which a text keeps them all
WHOLE = 128
HASH_DIGITS = 16
#: fixed values: white space between words
BLANKS = " \t\n\x0b\x0c\r"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row, also where it is used inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sketch(text: Column) -> Column:
    """struct(whole, hashes) of a text: hashes distinct and in order. NULL, empty and blank texts have a whole sketch without hashes."""
    plain = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    words = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, "[\\x20\\x09-\\x0D]+"))

    def hashes(w: Column) -> Column:
        n = F.size(w)
        last = F.greatest(n - (SHINGLE_WORDS - 1), F.lit(1))
        places = F.when(n > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        found = F.transform(places, lambda i: F.md5(F.array_join(F.slice(w, i, SHINGLE_WORDS), " ").cast("binary")))
        kept = F.when(last <= WHOLE, found).otherwise(F.filter(found, lambda h: h < BOUND))
        return F.struct((last <= WHOLE).alias("whole"), F.sort_array(F.array_distinct(F.transform(kept, lambda h: F.substring(h, 1, HASH_DIGITS)))).alias("hashes"))

    return _let(words, hashes)


def pack(of: Column) -> Column:
    """A sketch as bytes: one that says whether it is whole, then eight per hash. For shuffles and files."""
    return F.unhex(F.concat(F.when(of["whole"], "01").otherwise("00"), F.array_join(of["hashes"], "")))


def unpack(name: str) -> Column:
    """The sketch in a column of packed ones, under the same name."""
    digits = F.lower(F.hex(name))

    def hashes(text: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor(F.length(text) / HASH_DIGITS).cast("int") - 1)
        listed = F.transform(places, lambda i: F.substring(text, i * HASH_DIGITS + 3, F.lit(HASH_DIGITS)))
        return F.struct(text.startswith("01").alias("whole"), F.when(F.length(text) > 2, listed).otherwise(F.array().cast("array<string>")).alias("hashes"))

    return _let(digits, hashes).alias(name)


def _below(a: Column, b: Column) -> Column:
    """The hashes of ``a`` that can be compared with those of ``b``."""
    return F.when(a["whole"] & ~b["whole"], F.filter(a["hashes"], lambda h: h < BOUND)).otherwise(a["hashes"])


def _shares(a: Column, b: Column, use) -> Column:
    sides = F.struct(_below(a, b).alias("a"), _below(b, a).alias("b"))
    return _let(sides, lambda s: use(F.size(F.array_intersect(s["a"], s["b"])), F.size(s["a"]), F.size(s["b"])))


def _ratio(part: Column, whole: Column, a: Column, b: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise((F.size(a["hashes"]) + F.size(b["hashes"]) == 0).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both, 0 to 1; 1 for two sketches without hashes."""
    return _shares(a, b, lambda both, n, m: _ratio(both, n + m - both, a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, 0 to 1; 1 for two sketches without hashes."""
    return _shares(a, b, lambda both, n, m: _ratio(both, n, a, b))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts together."""
    return F.struct((a["whole"] & b["whole"]).alias("whole"), F.sort_array(F.array_union(_below(a, b), _below(b, a))).alias("hashes"))


def fingerprint(of: Column) -> Column:
    """A sketch as text: 1 for a whole one or the scale, a colon, its hashes one after another."""
    return F.concat(F.when(of["whole"], "1:").otherwise(f"{SCALE}:"), F.array_join(of["hashes"], ""))


def _followers(docs: DataFrame) -> DataFrame:
    """(doc, key, n_chars, next): each document's successor by key and tie, the first one's for the last.

    Keys are ranged over the partitions; a task sees its own range, and the first document of every range goes to all.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    ranged = docs.select("key", "tie", "doc", "n_chars").distinct().repartitionByRange(parts, *order)
    ranged = settle(ranged.withColumn("range", F.spark_partition_id()), "followers")
    # one row per partition
    firsts = ranged.groupBy("range").agg(F.min(F.struct("key", "tie", "doc"))["doc"].alias("first"))
    onward = Window.orderBy("range")
    whole = onward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("range", F.coalesce(F.lead("first").over(onward), F.first("first").over(whole)).alias("after"))
    own = F.lead("doc").over(Window.partitionBy("range").orderBy(*order))
    return ranged.withColumn("own", own).join(F.broadcast(firsts), "range").select("doc", "key", "n_chars", F.coalesce("own", "after").alias("next"))


def edited_fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    A text is edited by putting the first characters of the next document's text (in ascending order of key, NULL first; the first
    one's after the last) in place of its last quarter, rounded down; a shorter next text goes in whole. NULL texts count as empty. Rows that share a key
    stand in the order of a hash of their texts, and rows that agree in both are one document with equal results in each row.
    A document alone is its own next one. Other columns are dropped.

    Whole texts are shuffled once, by document; the beginning of each next text travels to the document that takes it.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), plain.alias("text"), F.xxhash64(plain).alias("tie"))
    rows = rows.withColumn("doc", F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit("/"), F.hex("tie")))
    followers = _followers(rows.select("key", "tie", "doc", F.length("text").cast("long").alias("n_chars")))
    # both joins read the same columns of this frame, so that its shuffle is done once
    texts = rows.select("doc", "text", pack(sketch(F.col("text"))).alias("sketch"))

    taken = F.floor(F.col("n_chars") / 4).cast("int")
    asked = followers.select(F.col("doc").alias("target"), "key", "n_chars", taken.alias("taken"), F.col("next").alias("doc"))
    found = texts.join(asked.hint("shuffle_merge"), "doc").withColumn("begins", F.substring(F.col("text"), F.lit(1), F.col("taken")))
    # rows that repeat the next document give the same
    given = found.groupBy(F.col("target").alias("doc")).agg(*[F.first(c).alias(c) for c in ("key", "n_chars", "taken", "begins")], F.first("sketch").alias("next_sketch"))
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.col("taken")).cast("int"))
    joined = texts.join(given.hint("shuffle_merge"), "doc")
    edited = joined.select("key", "n_chars", F.concat(kept, "begins").alias("edited_text"), unpack("sketch"), unpack("next_sketch"))
    edited = edited.withColumn("edited_sketch", sketch(F.col("edited_text")))
    return edited.select(
        F.col("key").alias(key), "n_chars", "edited_text", fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
