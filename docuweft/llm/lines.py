"""Lines that many documents share: found by range-partitioned hashes, answered as compressed keep bitmaps.

DataFrame functions only.  Lines are split into (hash, document, position) rows;
the texts themselves do not move until a caller applies the bitmaps.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Fixed: the white space that is stripped from a line's ends.
BLANK = " \t\n\x0b\x0c\r"
#: Keys that are dealt out to several ranges, at most.
HOT_KEYS = 2000
#: Share of lines looked at to find hot keys.  It steers only where rows go, never what is found.
HOT_SAMPLE = 0.02
#: Ranges a hot key is dealt out to.
HOT_SLOTS = 64


def key_of(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANK)), string.ascii_uppercase, string.ascii_lowercase)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _tag(text: Column) -> Column:
    """Tells apart rows that share a doc_id but not the text."""
    return F.xxhash64(text)


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, tag, pos, h1, h2) of every line whose key has ``min_chars`` code points or more."""
    return (
        docs.select("doc_id", _tag(F.col("text")).alias("tag"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "tag", "pos", key_of(F.col("line")).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("doc_id", "tag", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))
    )


def _hot_keys(found: DataFrame) -> list[int]:
    """The hashes most frequent in some of the rows, HOT_KEYS at most; a key that holds a noticeable share of the lines is among them."""
    seen = found.select("h1").sample(HOT_SAMPLE, seed=5).groupBy("h1").count()
    return [r["h1"] for r in seen.filter("count > 1").orderBy(F.desc("count"), "h1").limit(HOT_KEYS).collect()]


def drop_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(doc_id, tag, gaps) of the documents that lose lines.

    A line goes if its key stands in ``min_docs`` documents or more; with
    ``keep_first`` its first occurrence, by doc_id and position, stays.
    ``gaps`` is the document's keep bitmap, run-length coded: for each line
    that goes, how many lines stay since the one before that went.

    Hashes of 128 bits are range-partitioned and sorted by document and
    position, so that the first occurrence of a key and its documents are read
    off one ordered stream.  They are written to the shared folder first, as
    ranges are laid by a look at all rows and texts should be split once only.  Hot keys are dealt out to several ranges by a hash
    of the document and their counts added up.  Rows that share a doc_id count
    as one document, null ids too.
    """
    found = written(occurrences(docs, min_chars), "lines")
    hot = _hot_keys(found)
    is_hot = F.col("h1").isin(hot) if hot else F.lit(False)
    slot = F.when(is_hot, F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SLOTS)).cast("int")).otherwise(0)
    ranged = found.withColumn("slot", slot).repartitionByRange("h1", "h2", "slot")
    group = Window.partitionBy("h1", "h2", "slot")
    stream = group.orderBy("doc_id", "tag", "pos")
    rank = F.row_number().over(stream)
    opens = F.when((rank > 1) & F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id")), 0).otherwise(1)
    marked = ranged.withColumn("first", rank == 1).withColumn("opens", opens).withColumn(
        "docs", F.sum("opens").over(group.orderBy("doc_id", "tag", "pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    if hot:
        parts = marked.filter(is_hot & F.col("first")).groupBy("h1", "h2").agg(
            F.sum("docs").alias("_docs"), F.min(F.struct("doc_id", "tag", "pos")).alias("_first")
        )
        own = F.struct("doc_id", "tag", "pos")
        # hashes that share h1 with a hot one are part of it: at most as many rows as there are hot keys, but for collisions
        marked = marked.join(F.broadcast(parts), ["h1", "h2"], "left").select(
            "doc_id", "tag", "pos",
            F.coalesce("_docs", "docs").alias("docs"),
            F.when(F.col("_docs").isNotNull(), own.eqNullSafe(F.col("_first"))).otherwise(F.col("first")).alias("first"),
        )
    goes = F.col("docs") >= min_docs
    if keep_first:
        goes &= ~F.col("first")
    gone = marked.filter(goes).groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    return gone.select("doc_id", "tag", F.expr("transform(at, (x, i) -> x - if(i = 0, -1, at[i - 1]) - 1)").alias("gaps"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``text`` reduced to the kept lines, plus _n_lines and _n_dropped.

    A null text is one empty line.  Each row comes out once, whatever its
    doc_id; columns named like the two new ones give way to them.
    """
    marks = bitmaps.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), F.col("gaps").alias("_gaps"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), _tag(F.col("text")).alias("_own"), _lines(F.col("text")).alias("_lines"))
    joined = rows.join(marks, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_tag")), "left")
    marked = joined.withColumn("_keeps", F.expr("flatten(transform(_gaps, g -> concat(array_repeat(true, g), array(false))))"))
    kept = F.expr("if(_gaps is null, array_join(_lines, '\n'), array_join(filter(_lines, (l, i) -> coalesce(get(_keeps, i), true)), '\n'))")
    own = [c for c in docs.columns if c.lower() not in ("_n_lines", "_n_dropped")]
    return marked.select(
        *[kept.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in own],
        F.size("_lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_gaps"), F.lit(0)).cast("long").alias("_n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``docs`` without the lines that :func:`drop_bitmaps` finds, its columns unchanged, plus _n_lines and _n_dropped."""
    return apply_bitmaps(docs, drop_bitmaps(docs, min_docs, min_chars, keep_first))
