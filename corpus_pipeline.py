"""The corpus pipeline: quality filter, line, near and substring de-duplication, packing.

Every stage takes the rows that the one before kept, with the columns of ``documents``, and all but
the last return these columns; ``n_chars`` follows the text. Null texts stay null and an empty
table gives an empty table. Of rows equal in id and text one is left after the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordergrain.llm import lines, minhash, packing, quality, substrings
from ordergrain.llm.catalog import BYTE_BPE, good_labels
from ordergrain.llm.storage import settled, ship_package

ALONE = 40  # characters from which a repeated line goes whatever its neighbours
SIMILAR = 80  # least Jaccard similarity of near duplicates, in percent
PASSAGE = 200  # bytes; 51 words of the test documents have more in all but 3 of 10,000 places


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``changed``, whose text may differ."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*(f"`{c}`" for c in docs.columns))


def _hashes() -> tuple[Column, Column]:
    """Two hashes of a document's id and text; only both together tell documents apart."""
    return F.xxhash64("doc_id", "text"), F.xxhash64("text", "doc_id")


def filter_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ship_package(spark)
    return quality.accepted(docs, good_labels(spark, sf_dir))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of lines and of long lines; a document can become empty."""
    ship_package(spark)
    return _with_text(docs, lines.remove_repeated_lines(docs, alone=ALONE))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates, that with the smallest id; a null id comes last.

    Rows are told apart by two hashes of id and text: repeated rows are one, rows with null ids take part by their
    text, and different texts with one id are documents of their own.
    """
    ship_package(spark)
    document, other = _hashes()
    told = docs.select("doc_id", "text", document.alias("_document"), other.alias("_other"))
    groups = settled(
        spark,
        lambda: minhash.near_duplicates(told, key="_document", percent=SIMILAR).select("_document", "component_id").distinct(),
    )
    ids = told.select("_document", "_other", "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_document", "_other")
    least = groups.join(ids, "_document").groupBy("component_id").agg(F.min(order).alias("least"))
    # Documents that share the first hash by chance are in one group without being alike: all of them stay.
    alike = ids.groupBy("_document").agg(F.min("_other").alias("low"), F.max("_other").alias("high")).where("low <> high")
    clashing = ids.join(alike, "_document", "left_semi").select("_document", "_other")
    kept = least.select("least._document", "least._other").unionAll(clashing)
    once = docs.select("*", document.alias("_document"), other.alias("_other")).dropDuplicates(["_document", "_other"])
    return once.join(kept, ["_document", "_other"], "left_semi").select(*(f"`{c}`" for c in docs.columns))


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings that start elsewhere too; a character that loses a byte goes."""
    ship_package(spark)
    cut = substrings.remove_repeated(docs, length=PASSAGE, as_text=True)
    kept = F.when(F.col("text").isNotNull(), F.col("kept"))
    return _with_text(docs, cut.withColumn("text", kept))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 1024 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("quality", filter_by_quality),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_repeated_strings),
    ("packing", pack_sequences),
]
# The first stage is a statistical model, which SQL cannot express; tests/llm checks the stages
# against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
