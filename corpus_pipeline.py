"""A corpus pipeline over ``documents``: five stages, each one operator of ``corpusflow.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; all but the last return the columns of ``documents``. ``run`` stores every
stage's rows as Parquet in the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import op4_language, op5_minhash, op6_pii, op7_lines, op8_packing
from corpusflow.llm.common import stored, table
from corpusflow.session import ship_package

#: Near duplicates: words per shingle, and similarity in percent.
SHINGLE, SIMILARITY = 5, 80


def _recounted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """``n_chars`` follows the changed text, where the table has that column."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go (no letter, or score under its bound)."""
    ship_package(spark)
    # the other columns travel as one struct, so that the predicted ones cannot replace any
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("text", F.struct(*[docs[f"`{c}`"] for c in others]).alias("own"))
    found = op4_language.predict(rows, op4_language.fit(docs)).where("accepted")
    return found.select(*[F.col("text") if c == "text" else F.col("own").getField(c).alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, up to two edits, go from the texts."""
    ship_package(spark)
    return _recounted(op7_lines.dedup_lines(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least doc_id; of
    different texts under that id the one with the least md5; of rows equal in both the one
    with the least hash of all columns. Rows without an id stay only in groups without any.
    Documents without words are in no group and stay."""
    ship_package(spark)
    found = stored(op5_minhash.near_duplicates(docs, SIMILARITY, SHINGLE, named=True).where("n_shingles > 0"), "near_groups")
    texts = found.groupBy("component", "doc_id", "text_md5").agg(F.count("*").alias("times"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_md5")
    best = texts.groupBy("component").agg(F.min(row).alias("best"))
    judged = texts.join(best, "component").withColumn("stays", row == F.col("best"))
    gone = stored(judged.where("not stays").select("doc_id", "text_md5").distinct(), "near_gone")
    docs_id, name = docs["doc_id"].cast("long"), F.md5(F.coalesce(docs["text"], F.lit("")))
    left = docs.join(gone, docs_id.eqNullSafe(gone["doc_id"]) & (name == gone["text_md5"]), "left_anti")
    twice = stored(judged.where("stays and times > 1").select("doc_id", "text_md5"), "near_twice")
    if twice.isEmpty():
        return left
    same = docs_id.eqNullSafe(twice["doc_id"]) & (name == twice["text_md5"])
    own = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = left.join(twice, same).select(twice["doc_id"].alias("id"), twice["text_md5"].alias("md5"), own.alias("own"))
    one = rows.groupBy("id", "md5").agg(F.min_by("own", F.xxhash64("own")).alias("own"))
    return left.join(twice, same, "left_anti").union(one.select("own.*"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes its kind in brackets."""
    ship_package(spark)
    return _recounted(op6_pii.redacted(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences: one row per piece with its ids."""
    import public_tokenizers

    ship_package(spark)
    return op8_packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packing),
]

#: SQL cannot express language models or packings; tests/llm holds the line and near-duplicate stages against brute force, the language and personal-data stages against their operators; packing only through op8's tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
