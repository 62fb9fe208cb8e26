"""Quality rules: word and line statistics of each text, and cross-document line frequency.

DataFrame functions only. Lines are normalised (A-Z lower-cased, runs of separators made one space, trimmed) and
hashed; for each host the documents that hold a line are counted. Lines above the limit are boilerplate and are removed; a
document that loses more than half of its words with them is depleted and goes. judge() gives the verdicts, cleaned()
the documents that stay, without those lines.

Nulls and edge cases: a null text has no words and fails the base rules; a null host is a host of its own; repeated
rows are documents of their own; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, ascii_lower, let, stored

#: More documents of one host than this make a line boilerplate.
MAX_DOCS = 10
#: Least share of a document's words that must remain without its boilerplate.
MIN_LEFT = 0.5


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more among words.

    Windows are compared by a 64-bit hash of their words. Most texts repeat none, which a set of hashes tells; else the
    sorted (hash, place) pairs show equal neighbours, and the sorted places how far their windows overlap.
    """
    none = F.lit(0).cast("long")

    def cover(p: Column) -> Column:
        gap = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(gap, none, lambda a, x: a + x)

    def places(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, F.when(k > 0, k - 1))["h"] == x["h"], F.lit(False))
        return let(F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"])), cover)

    def counted(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(let(pairs, places))

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(F.size(words) < 3, none).otherwise(let(hashes(words), counted))


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit("\x00"))


def _text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(line), SPACE, " "))


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row the base statistics, and lines: the distinct normalised lines as (hash, words in all its copies)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = df.select(F.col(id_col).alias("id"), _host(host_col).alias("host"), text.alias("t"), *_text_key(text), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))

    def lined(lines: Column) -> Column:
        plain = F.transform(lines, _normal)
        pairs = F.transform(plain, lambda x: F.struct(F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))
        return F.struct((F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), pairs.alias("pairs"))

    stats = let(F.col("w"), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    lines = let(F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD)), lined)
    return row.select(
        "id", "host", "h1", "h2", stats.alias("s"), lines.alias("l"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    ).select("id", "host", "h1", "h2", "s.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "s.n_repeat_words", F.col("l.pairs").alias("lines"))


def boilerplate(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, h) of the lines that more than max_docs documents of the host hold; lines has one (host, h) per document."""
    return lines.groupBy("host", "h").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs).select("host", "h")


def _verdicts(rows: DataFrame, max_docs: int, min_left: float) -> DataFrame:
    """rows (measured, with a number row, stored) with failed, n_left, kept and lost (hashes of the lines that go, if any)."""
    each = rows.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.h", "x.n")
    once = rows.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    frequent = stored(boilerplate(once, max_docs))  # stored, so that a hot line's rows can be split
    lost = each.join(frequent, ["host", "h"]).groupBy("row").agg(F.sum("n").cast("long").alias("n_lost"), F.collect_set("h").alias("lost"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = rows.join(lost, "row", "left").withColumns({"failed": failed, "n_left": F.col("n_words") - F.coalesce("n_lost", F.lit(0))})
    return out.withColumn("kept", ~F.col("failed") & (F.col("n_left") >= min_left * F.col("n_words")))


def _rows(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    return stored(measured(df, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per input row: the statistics, base_failed, n_left (words outside boilerplate lines) and kept."""
    out = _verdicts(_rows(df, id_col, text_col, host_col), max_docs, min_left)
    return out.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("failed").alias("base_failed"), "kept", "n_left")


def cleaned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The rows of df that judge() keeps, their texts without boilerplate lines; columns as they were.

    A verdict depends on the host and the text alone, so these join it to the rows.
    """
    judged = _verdicts(_rows(df, id_col, text_col, host_col), max_docs, min_left).where("kept")
    judged = stored(judged.groupBy(F.col("host").alias("_host"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(F.first("lost").alias("_lost")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2 = _text_key(text)
    rows = df.withColumns({"_host": _host(host_col), "_h1": h1, "_h2": h2}).join(judged, ["_host", "_h1", "_h2"])
    stays = lambda line: ~line.rlike(WORD) | ~F.array_contains(F.col("_lost"), F.xxhash64(_normal(line)))
    fresh = F.when(F.col("_lost").isNull(), F.col(text_col)).otherwise(F.array_join(F.filter(F.split(text, "\n", -1), stays), "\n"))
    out = rows.withColumn(text_col, fresh)
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.when(F.col("_lost").isNotNull(), F.length(text_col).cast(df.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
