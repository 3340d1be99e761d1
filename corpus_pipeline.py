"""A training corpus from raw documents: quality, repeated lines, near-duplicates, personal data, packed sequences.

Each stage takes all that the one before kept, written as Parquet and read
again, and returns the columns of ``documents``; the last returns the pieces of
the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docuweft.llm import compression, lines, minhash, packing, pii
from docuweft.llm.common import table
from docuweft.llm.queries import TRAINED, WORD_BPE
from docuweft.session import written


def _with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, where there is one, made that of the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good."""
    model = compression.train(docs, table(spark, sf_dir, "labels"), where=TRAINED)
    return compression.score_quality(docs, model).filter("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share, but for a line's first occurrence; all documents stay.

    So of ten or more copies the first keeps its text, and the rest are emptied.
    """
    return _with_size(lines.dedup_lines(docs, min_docs=10, min_chars=1, keep_first=True).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles: the one with the smallest doc_id.

    Rows that repeat a doc_id are told apart by their texts; of rows that repeat
    both one stays.  Documents without an id stay.  SimHash links come first,
    confirmed by the shingles; as they cannot reach that similarity, MinHash
    lists find what is left, see README for figures.
    """
    groups = minhash.near_copies(docs, width=5, least=0.8)
    stays = groups.groupBy("part").agg(F.min(F.struct("doc_id", "tag")).alias("first")).select(
        F.col("first.doc_id").alias("_stays"), F.col("first.tag").alias("_tagged")
    )
    own = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), minhash.tag_of(F.col("text")).alias("_tag"))
    kept = own.join(stays, (F.col("_doc") == F.col("_stays")) & (F.col("_tag") == F.col("_tagged")), "left_semi").dropDuplicates(["_doc", "_tag"])
    return kept.select("_row.*").unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    return _with_size(pii.mask_pii(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
