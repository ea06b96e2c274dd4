"""A corpus pipeline: keep good documents, one of each near-duplicate group, cut repeated
passages, drop benchmark leaks, and encode.

Each stage takes the documents that the one before kept, as a written table, and returns
documents with the same columns; the last returns their tokens. No stage can be said in
SQL as a whole (a fitted model, probabilistic signatures, byte spans, a tokenizer's merges), so
each is tested against a brute-force version on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.bpe import bpe_tokens, vocabulary_path
from wakeline.llm.decontam import drop_leaks
from wakeline.llm.near_dup import one_per_class
from wakeline.llm.quality_model import fit, score_documents
from wakeline.llm.suffix_dedup import remove_repeats
from wakeline.llm.tables import ship_package, stored


def _set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns but doc_id and text under names that no operator uses, and those names by column."""
    names = {c: f"_column_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names), names


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tail probability of the top grade the classifier accepts, with all their columns.

    Defined cases: those of :func:`score_documents`; with no labels, or labels of the top grade only, all stay.
    """
    ship_package(spark)
    model = fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    apart, names = _set_apart(docs)
    kept = score_documents(apart, model).where("kept")
    return kept.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class, with all its columns; defined cases as in :func:`one_per_class`."""
    ship_package(spark)
    return one_per_class(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings that start earlier; whole characters only.

    A document that consists of such strings stays with an empty text, as do those with a null one. ``n_chars``, where
    there is such a column, is that of the new text; all other columns stay. Further defined cases: :func:`remove_repeats`.
    """
    ship_package(spark)
    apart, names = _set_apart(docs)
    cut = remove_repeats(apart, keep=tuple(names.values()))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*(new.get(c, F.col(names.get(c, c))).alias(c) for c in docs.columns))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into, with all their columns; defined cases as in :func:`drop_leaks`."""
    ship_package(spark)
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: token ids (little-endian u32) and the text that they decode to.

    Every row is encoded; defined cases as in :func:`bpe_tokens`.
    """
    ship_package(spark)
    return bpe_tokens(docs, vocabulary_path()).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark leaks", benchmark_leaks),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
