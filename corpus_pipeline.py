"""The corpus pipeline: language ID, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; ``run`` writes a stage's rows as Parquet
to the shared folder and the next one reads them from there. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arterial.llm import decontaminate, jaccard, langid, packing, pii
from arterial.session import configure, pin

MIN_LANGUAGE_SHARE = 0.4  # of a text's words, by the most likely language

# two stages hold models that are trained on the rows, so SQL cannot express run(); tests/llm has a brute-force version
ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one struct, so that their names can be anything."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_other"), "text")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("_other")[c].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or without a language that holds ``MIN_LANGUAGE_SHARE`` of the words, go."""
    found = langid.identify(_packed(docs), langid.fit_languages(docs))
    accepted = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SHARE))
    return _unpacked(accepted, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by Jaccard similarity of 0.8 or more on five-word shingles, the smallest id stays.

    Of repeated rows with that id one stays; rows without id stay. Texts are not shuffled as long as the ids that go are
    few enough to be broadcast (``jaccard.small`` counts them).
    """
    linked = pin(jaccard.link_documents(docs, words=5, percent=80).select("doc_id", "component_id"))
    gone = linked.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = linked.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    repeated = pin(repeated.join(gone, "doc_id", "left_anti"))
    kept = docs.join(jaccard.small(pin(gone.unionByName(repeated))), "doc_id", "left_anti")
    if not repeated.isEmpty():
        kept = kept.unionByName(docs.join(jaccard.small(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return kept.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which benchmark windows hold at least one word in twenty go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _unpacked(decontaminate.remove_contamination(decontaminate.mark_contamination(_packed(docs), benchmark)), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>`` and ``<PHONE>``; n_chars follows the text."""
    masked = pii.find_pii(_packed(docs), pii.fit_pii(docs), keep=["_other"], masked_col="text")
    return _unpacked(masked, docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, keep=["doc_id"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = pin(docs)
    return docs
