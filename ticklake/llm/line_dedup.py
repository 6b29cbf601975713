"""Line-level dedup with built-in functions only: lines whose key stands in many documents go everywhere.

A document's lines are its text split at line feeds. A line's key is the line without the characters
``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys are compared by 128 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import attach, settle

#: fixed values: the white space that is stripped
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: repeated keys of a document up to which each of its lines is compared with all of them
LOOK_THROUGH = 32


def line_key(line: Column) -> Column:
    plain = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(plain) == F.length(plain), F.lower(plain)).otherwise(F.translate(plain, UPPER, LOWER))


def key_hash(line: Column) -> Column:
    """128 bits of the key of a line; NULL for lines that never count (see ``min_chars``)."""
    key = line_key(line)
    return F.struct(F.xxhash64(F.lit(1), key).alias("a"), F.xxhash64(F.lit(2), key).alias("b"))


def document_id(key: str, text: str) -> Column:
    """Identity of a document: its key, or for rows without one their text."""
    return F.struct(F.col(key).isNull().alias("no_key"), F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(text, F.lit("")))).alias("id"))


def repeated_lines(docs: DataFrame, key: str, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(hash, document, n_docs): the repeated keys that each document holds.

    Counting needs (document, key hash) pairs only, distinct before the shuffle; a key that every document holds is one
    row per task after that. Attaching the counts broadcasts the most frequent keys, of which there is a fixed number at most.
    """
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) >= max(min_chars, 1))
    pairs = docs.select(document_id(key, text).alias("document"), F.explode(F.array_distinct(F.transform(lines, key_hash))).alias("hash"))
    pairs = settle(pairs.select("hash.a", "hash.b", "document").distinct(), "lines")
    repeated = settle(pairs.groupBy("a", "b").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs), "repeated_lines")
    return attach(pairs, repeated, ["a", "b"], "n_docs")


def _holds(ordered: Column, value: Column) -> Column:
    """Whether an array in order has a value: by looking through a short one, by halving steps in a long one, so that a document
    of n lines costs n log n at most."""
    def look(bound):
        h, n = bound["h"], F.size(ordered)
        # the last place whose value is not above h
        place = F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(31))]), F.lit(0), lambda at, step: F.when((step < n - at) & (F.get(ordered, at + step) <= h), at + step).otherwise(at))
        return F.coalesce(F.get(ordered, place) == h, F.lit(False))

    return F.when(F.size(ordered) <= LOOK_THROUGH, F.array_contains(ordered, value)).otherwise(F.element_at(F.transform(F.array(F.struct(value.alias("h"))), look), 1))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` reduced, plus ``line_stats`` struct(n_lines, n_dropped).

    Lines whose key has at least ``min_chars`` code points and stands in at least ``min_docs`` documents lose all their
    occurrences, in every document; the rest keeps its order, joined by line feeds. Blank lines stay for ``min_chars`` >= 1.
    NULL or empty text: one empty line, which stays; the result is the empty text. Rows that share a key are one document when documents are
    counted, and each row is cleaned by itself. Rows without key count as one document per distinct text. An input column
    called ``line_stats`` is replaced.
    """
    found = repeated_lines(docs, key, text, min_docs, min_chars)
    per_document = found.groupBy("document").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("_repeated"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), document_id(key, text).alias("document"))
    joined = rows.join(per_document, "document", "left")
    lines = F.split(F.coalesce(F.col(f"row.{text}"), F.lit("")), "\n", -1)
    kept = F.when(F.col("_repeated").isNull(), lines).otherwise(F.filter(lines, lambda x: ~_holds(F.col("_repeated"), key_hash(x))))
    cleaned = joined.select("row", lines.alias("lines"), kept.alias("kept"))
    others = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in (text, "line_stats")]
    stats = F.struct(F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))
    return cleaned.select(*others, F.array_join("kept", "\n").alias(text), stats.alias("line_stats")).select(*[c for c in docs.columns if c != "line_stats"], "line_stats")
