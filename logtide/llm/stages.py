"""A training corpus from ``documents``: language ID, near-duplicate removal, PII, mixing, packing.

Every stage works on all rows of the one before, written as Parquet and read again. None can be expressed in SQL: tests
hold each against a plain version. All stages but the last return the columns of their input; an empty input gives an
empty output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtide.llm import language, mixing, packing, pii, shingle_join
from logtide.llm.common import documents, held_out
from logtide.session import written

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language cannot be told: null text, or no letter in it. Others get the language found.

    If no language can be learned, documents with a letter stay as they are. Ids play no part, so null and repeated ones
    stay; equal texts get equal languages.
    """
    model = language.fit(docs, ~held_out())
    if not model["langs"]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    places = [f"_{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    found = language.predict(docs.toDF(*places), model, text_col=places[at], keep=tuple(places))
    kept = found.where(F.col("lang_pred") != language.UNDETERMINED)
    return kept.select(*[F.col("lang_pred" if c == "lang" else p).alias(c) for p, c in zip(places, docs.columns, strict=True)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by 5-word shingles at Jaccard 0.8: the one with the smallest id.

    Texts are compared, not ids: rows that share an id and have different texts are documents of their own. Null ids come
    last; ties in the id go to the smaller digest of the text. Documents without words link with nothing and stay.
    """
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if repeated.isEmpty():
        kept = shingle_join.component_ids(docs).where("doc_id = component_id").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    # Rows get a number of their own, pinned by writing it, where ids do not tell them apart.
    numbered = written(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_doc")), "numbered")
    groups = shingle_join.component_ids(numbered.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text")))
    order = F.struct(F.col("_doc.doc_id").isNull(), F.col("_doc.doc_id"), F.sha2(F.coalesce("_doc.text", F.lit("")), 256), F.col("_row"))
    member = numbered.select("_row", order.alias("_order")).join(groups.select(F.col("doc_id").alias("_row"), "component_id"), "_row")
    first = member.groupBy("component_id").agg(F.min_by("_row", "_order").alias("_row"))
    return numbered.join(first, "_row", "left_semi").select("_doc.*")


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; every document stays. ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents of each source, some more than once, so that words come near the sources' targets.

    Null sources are one source; documents without words have nothing to add and are left out. Repeated rows and null ids
    are drawn each on its own.
    """
    return mixing.mixed_rows(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 4096; null text counts as empty, repeated rows are packed each."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("pii", pii_redaction),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
