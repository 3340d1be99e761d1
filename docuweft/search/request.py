"""Search requests over documents: filters, pages, totals and highlights."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schema import ANALYZER_OF
from ..session import BROADCAST_ROWS, broadcast_if_small
from .analyze import ANALYZERS, TOKEN, Analyzer, analyzed, tokens, word_terms

# Page size, its limit, and the mark around a matched word.
DEFAULT_LIMIT, MOST = 20, 100
MARK = ("<em>", "</em>")


def checked_requests(queries: DataFrame) -> DataFrame:
    """Requests with defaults filled in; a limit out of 1..100 or a negative offset is an error."""
    limit, offset = F.coalesce("limit", F.lit(DEFAULT_LIMIT)), F.coalesce("offset", F.lit(0))
    bad = ~limit.between(1, MOST) | (offset < 0)
    said = F.concat(F.lit("limit or offset out of range in request "), F.col("query_id").cast("string"))
    return queries.withColumns({
        "limit": F.when(bad, F.raise_error(said).cast("int")).otherwise(limit),
        "offset": F.when(bad, F.raise_error(said).cast("int")).otherwise(offset),
    })


def matches(docs: DataFrame, queries: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """(query_id, limit, offset, document…): documents of the request's tenant that pass its filters.

    Requests are few and go to the documents, each read once.  With ``scores``
    (query_id, id, score) only scored documents are looked at.
    """
    asked = checked_requests(queries).select(
        "query_id", "limit", "offset",
        F.col("client_id").alias("_client"), F.col("modules").alias("_modules"), F.col("status").alias("_status"),
        F.col("date_from").alias("_from"), F.col("date_to").alias("_to"),
    )
    asked = broadcast_if_small(asked)
    passes = (
        (F.col("client_id") == F.col("_client"))
        & _in(F.col("module"), F.col("_modules"))
        & _in(F.col("status"), F.col("_status"))
        & (F.col("_from").isNull() | (F.col("date") >= F.col("_from")))
        & (F.col("_to").isNull() | (F.col("date") <= F.col("_to")))
    )
    if scores is not None:
        asked = scores.withColumnRenamed("id", "_id").join(asked, "query_id")
        passes = passes & (F.col("id") == F.col("_id"))
    return docs.join(asked, passes).drop("_client", "_modules", "_status", "_from", "_to", "_id")


def _in(value: Column, allowed: Column) -> Column:
    return allowed.isNull() | F.array_contains(allowed, value)


def pages(found: DataFrame, by: str) -> DataFrame:
    """Each request's page of its matches, with ``rank`` and the request's ``total``; matches are made once.

    Ranks go by falling ``by`` (nulls last), then id.  Each task counts the
    matches of a request and keeps as many of the first as its page reaches;
    only these move, so no task sees all matches of a request.
    """
    layout = T.StructType([*found.schema.fields, T.StructField("matched", T.LongType())])
    dated = isinstance(found.schema[by].dataType, T.DateType)
    whole = to_arrow_schema(layout)

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, counts = None, Counter()
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            counts.update({c["values"]: c["counts"] for c in rows["query_id"].value_counts().to_pylist()})
            kept = _first_rows(rows if kept is None else pa.concat_tables([kept, rows]), by, dated)
        if kept is not None and kept.num_rows:
            # the count of a request stands at one of its rows
            matched = pa.array([counts.pop(q, 0) for q in kept["query_id"].to_pylist()], pa.int64())
            yield from kept.append_column("matched", matched).cast(whole).to_batches()

    near = found.mapInArrow(first_of_each, layout)
    mine = Window.partitionBy("query_id")
    ranked = near.withColumn("rank", F.row_number().over(mine.orderBy(F.col(by).desc_nulls_last(), F.col("id"))))
    ranked = ranked.withColumn("total", F.sum("matched").over(mine))
    page = (F.col("rank") > F.col("offset")) & (F.col("rank") <= F.col("offset") + F.col("limit"))
    return ranked.filter(page).drop("limit", "offset", "matched")


def _first_rows(rows: pa.Table, by: str, dated: bool) -> pa.Table:
    """The rows of each request up to the end of its page."""
    key = rows[by].cast(pa.int32()) if dated else rows[by]
    frame = pd.DataFrame({"query_id": rows["query_id"].to_pandas(), "by": key.to_pandas(), "id": rows["id"].to_pandas()})
    frame = frame.sort_values(["by", "id"], ascending=[False, True], na_position="last", kind="stable")
    reach = (rows["offset"].to_numpy() + rows["limit"].to_numpy())[frame.index]
    return rows.take(frame.index[frame.groupby("query_id", sort=False, dropna=False).cumcount().to_numpy() < reach].to_numpy())


def search(docs: DataFrame, queries: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Pages of hits: by score where scores (query_id, id, score) are given, else newest first.

    Filters and ranks need a few columns; whole documents are fetched for the
    pages alone.
    """
    found = matches(docs.select("client_id", "id", "module", "status", "date"), queries, scores)
    page = pages(found, "date" if scores is None else "score").drop("module", "status", "date")
    # A page has at most MOST rows a request.
    if queries.count() <= BROADCAST_ROWS // MOST:
        page = F.broadcast(page)
    return docs.join(page, ["client_id", "id"])


def exact(docs: DataFrame, field: str, values: Sequence[str]) -> DataFrame:
    """Documents whose keyword field equals one of the values."""
    return docs.filter(F.col(field).isin(list(values)))


def marked(text: Column, words: Column) -> Column:
    """The text with every token found in ``words`` (lower case) marked."""
    pieces = F.regexp_extract_all(text, F.lit(rf"{TOKEN}|(?s:.)"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: _mark(p, words)), "")


def _mark(piece: Column, words: Column) -> Column:
    return F.when(F.array_contains(words, F.lower(piece)), F.concat(F.lit(MARK[0]), piece, F.lit(MARK[1]))).otherwise(piece)


def fragments(text: Column, words: Column) -> Column:
    """The sentences or lines of a text that hold a matched word, marked; whole texts are searched.

    A sentence ends at a mark that white space follows: one inside a number or a word does not cut it.
    """
    parts = F.transform(F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\n"), "\n"), lambda p: marked(F.trim(p), words))
    return F.filter(parts, lambda p: F.contains(p, F.lit(MARK[0])))


def matched_words(text: Column, terms: Column, analyzer: Analyzer) -> Column:
    """The words of a text, lower case and each once, whose term under an analyzer is among ``terms``."""
    own = F.array_distinct(tokens(F.coalesce(text, F.lit(""))))
    if analyzer.plain:
        return F.array_intersect(own, terms)
    pairs = F.arrays_zip(own.alias("word"), F.split(word_terms(analyzer)(F.array_join(own, " ")), " ").alias("term"))
    return F.transform(F.filter(pairs, lambda p: F.array_contains(terms, p["term"])), lambda p: p["word"])


def highlight(hits: DataFrame, words: Column, fields: Sequence[str] = ("title", "text_content")) -> DataFrame:
    """Add ``highlight``: field -> fragments, only for fields that have any; ``words`` are marked as they stand."""
    return _highlighted(hits, {f: words for f in fields})


def highlight_requests(
    hits: DataFrame, queries: DataFrame, fields: Sequence[str] = ("title", "text_content"), analyzers: Mapping[str, Analyzer] | None = None
) -> DataFrame:
    """Hits (query_id, …) with the fragments that match their own request (query_id, query).

    A word is marked if a field's analyzer makes of it a term it also makes of
    the request, synonyms included.
    """
    used = {f: (analyzers or {}).get(f) or ANALYZERS[ANALYZER_OF[f]] for f in fields}
    asked = queries.select("query_id")
    for n, f in enumerate(fields):
        terms = analyzed(queries.select("query_id", F.col("query").alias("_q")), "_q", used[f]).select("query_id", F.col("terms").alias(f"_terms{n}"))
        asked = asked.join(terms, "query_id")
    rows = hits.join(broadcast_if_small(asked), "query_id", "left")
    rows = rows.withColumns({f"_words{n}": matched_words(F.col(f), F.coalesce(f"_terms{n}", F.array().cast("array<string>")), used[f]) for n, f in enumerate(fields)})
    marked_rows = _highlighted(rows, {f: F.col(f"_words{n}") for n, f in enumerate(fields)})
    return marked_rows.drop(*[f"_{part}{n}" for n in range(len(fields)) for part in ("terms", "words")])


def _highlighted(hits: DataFrame, words: Mapping[str, Column]) -> DataFrame:
    found = F.map_from_arrays(
        F.array(*[F.lit(f) for f in words]),
        F.array(*[F.coalesce(fragments(F.col(f), w), F.array().cast("array<string>")) for f, w in words.items()]),
    )
    return hits.withColumn("highlight", F.map_filter(found, lambda _, v: F.size(v) > 0))
