"""Lines that many documents repeat, dropped from all but one of them, in
DataFrame operations only.

1. Each document's lines become (hash, document, position) rows; a line's key is
   the line without white space at its ends, A-Z in lower case, and its hash has
   128 bits.  Texts go no further.
2. The rows are range-partitioned on (hash, document) and sorted by hash,
   document (last first) and position.  The document is part of the range, so a
   line that a third of all documents share spans many partitions.
3. A pass over each sorted partition streams one row per (hash, document), the
   line's first occurrence there; that needs no other shuffle, as the ranges keep
   such rows together.  Occurrences are folded to (hash, documents, last document)
   in the map tasks, so what is shuffled is a row per hash and partition.
4. Rows of hashes in enough documents, but for those of the last one, are the
   lines to drop.  They become a bitmap per document, compressed to the 64-bit
   words that drop something.  ``apply_bitmap`` makes the text from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import ascii_lower
from refinery.session import discard, materialize

WHITE = " \t\n\x0b\f\r"
ALL = -1                     # a bitmap word that keeps its 64 lines


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(WHITE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keep_bitmaps(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 min_chars: int = 20, min_documents: int = 3) -> DataFrame:
    """(id, text_hash, n_dropped, keep) of the documents that lose lines:
    ``keep`` holds the bitmap words (word, bits; word w is for lines 64 w to
    64 w + 63, a set bit keeps its line) that drop one, in order.

    A line whose key has ``min_chars`` code points and is found in
    ``min_documents`` documents stays only in the document with the largest id
    that holds it, there as often as it stands.  Rows with the same id count as
    one document and lose or keep a line alike; a null id is a document, smaller
    than all others.  A null or empty text is one empty line.  ``text_hash`` tells
    rows of one id apart; rows that are the same in both share their bitmap."""
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"),
                       F.posexplode(_lines(F.col(text_column))).alias("pos", "line"))
    rows = rows.filter(F.char_length("line") >= min_chars).withColumn("line", F.trim("line", F.lit(WHITE)))
    rows = rows.filter(F.char_length("line") >= min_chars).withColumn("line", ascii_lower(F.col("line")))
    hashed = materialize(rows.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                                     "id", "text_hash", "pos"), "line-hashes")

    # a range never cuts (hash, document), so the window needs no shuffle of its own
    same_line = Window.partitionBy("h1", "h2", "id").orderBy("text_hash", "pos")
    ranges = hashed.repartitionByRange("h1", "h2", F.col("id").desc_nulls_last())
    first = ranges.withColumn("nth", F.row_number().over(same_line)).filter("nth = 1")
    lines = first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("documents"), F.max("id").alias("last"))
    shared = materialize(lines.filter(F.col("documents") >= min_documents).select("h1", "h2", "last"), "line-shared")

    gone = hashed.join(shared, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("last")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(63))
    words = gone.groupBy("id", "text_hash", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(bit).alias("out"))
    kept = F.struct("word", F.bitwise_not("out").alias("bits"))
    out = materialize(words.groupBy("id", "text_hash").agg(F.sum(F.bit_count("out")).alias("n_dropped"),
                                                           F.sort_array(F.collect_list(kept)).alias("keep")), "line-bitmaps")
    discard(hashed, shared)
    return out


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``n_lines``, ``n_dropped``, ``keep`` (null:
    every line stays) and ``text``, the lines that stay, joined by newlines."""
    # words that drop nothing are filled in again, once per document, so that a line finds its word by number
    skipped = F.transform("keep", lambda x, i: F.concat(
        F.array_repeat(F.lit(ALL).cast("long"), x["word"] - F.coalesce(F.get("keep", i - 1)["word"], F.lit(-1)) - 1), F.array(x["bits"])))
    words = bitmaps.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), "n_dropped", "keep",
                           F.flatten(skipped).alias("__words"))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("__text"), F.xxhash64(text_column).alias("__of"))
    rows = rows.join(words, F.col("id").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__hash")), "left")

    def stays(_line: Column, i: Column) -> Column:
        word = F.coalesce(F.get("__words", F.shiftright(i, 6)), F.lit(ALL).cast("long"))
        return F.call_function("shiftright", word, i.bitwiseAND(63)).bitwiseAND(1) == 1

    lines = _lines(F.col("__text"))
    text = F.when(F.col("keep").isNull(), F.coalesce("__text", F.lit(""))).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return rows.select("id", F.size(lines).cast("long").alias("n_lines"),
                       F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep", text.alias("text"))
