"""Token counts kept as rollups by source, language and tokenizer version.

A batch of changes (new, revised or deleted counts) becomes signed rows against
the ledger: an insert adds, a delete subtracts, a revision subtracts the old and
adds the new count. Totals are sums of the signed rows of committed batches, so
no total is ever rewritten. A batch is written to its own folder and becomes
visible with its commit mark; the same batch id committed again changes nothing,
and a batch that broke off is written anew.

Defined cases: a null text has no tokens; null source, language or doc_id are
groups and ids of their own; of repeated ids in a batch the largest count stands;
deleting an unknown id does nothing; an empty batch commits and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import WORD, stored, table, with_group_min
from .tokens import WordEncoder, encoder, file_bytes

KEY = ["doc_id", "version"]
DIMENSIONS = ["source", "lang", "version"]
LEDGER = "doc_id long, version string, source string, lang string, d_docs long, d_tokens long"
TOTALS = "source string, lang string, version string, d_docs long, d_tokens long"


class TokenRollup:
    """Ledger and totals under ``root`` in the shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _mark(self, batch: str):
        return self._path(f"{self.root}/commits/{batch}")

    def batches(self) -> list[str]:
        """Committed batch ids."""
        folder = self._path(f"{self.root}/commits")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{kind}/{b}" for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        """Current count of every live (doc_id, version)."""
        rows = self._read("ledger", LEDGER).groupBy(*KEY, "source", "lang")
        summed = rows.agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        return summed.where("d_docs > 0")

    def totals(self) -> DataFrame:
        """Documents and tokens of every group that still has documents."""
        summed = self._read("totals", TOTALS).groupBy(*DIMENSIONS)
        return summed.agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")).where("n_docs > 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (doc_id, version, source, lang, n_tokens, deleted) once;
        False if the batch is committed already."""
        if self._fs.exists(self._mark(batch)):
            return False
        rank = F.struct("n_tokens", "source", "lang")
        change = changes.groupBy(*KEY).agg(F.max(rank).alias("_row"), F.min("deleted").alias("deleted")).select(*KEY, "_row.*", "deleted")
        new = change.where(~F.col("deleted")).select(*KEY, "source", "lang", F.lit(1).cast("long").alias("d_docs"),
                                                     F.col("n_tokens").cast("long").alias("d_tokens"))
        hit = change.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
        now = self.ledger()
        same = now["doc_id"].eqNullSafe(hit["_id"]) & now["version"].eqNullSafe(hit["_version"])
        old = now.join(hit, same, "left_semi").withColumns({"d_docs": -F.col("d_docs"), "d_tokens": -F.col("d_tokens")})
        signed = new.unionByName(old).groupBy(*KEY, "source", "lang").agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        signed = signed.where("d_docs <> 0 or d_tokens <> 0")
        signed.write.mode("overwrite").parquet(f"{self.root}/ledger/{batch}")
        delta = self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger/{batch}").groupBy(*DIMENSIONS)
        delta.agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens")).write.mode("overwrite").parquet(f"{self.root}/totals/{batch}")
        self._fs.create(self._mark(batch), False).close()
        return True


def token_counts(docs: DataFrame, tokenizer: Broadcast) -> DataFrame:
    """doc_id, source, lang, n_words and n_tokens of every row."""
    names = ["doc_id", "source", "lang", "n_words", "text_md5"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(WordEncoder, tokenizer.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                n = [len(x) // 4 for x in enc.encode(batch.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(n, pa.int64())], [*names, "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    cols = docs.select("text", F.col("doc_id").cast("long"), "source", "lang", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
                       F.md5(text).alias("text_md5"))
    return cols.mapInArrow(run, "doc_id long, source string, lang string, n_words long, text_md5 string, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents: provisional counts (words),
    revised counts (tokenizer ids), exact copies deleted, and the revision once more."""
    import public_tokenizers

    raw = file_bytes(spark, public_tokenizers.path("word_bpe_49k.json"))
    counts = stored(token_counts(table(spark, sf_dir, "documents"), raw).withColumn("version", F.lit("word_bpe_49k")), "token_counts")
    rollup = TokenRollup(spark, scratch_path(spark, "llm", "rollup"))
    base = [*KEY, "source", "lang"]
    insert = counts.select(*base, F.col("n_words").alias("n_tokens"), F.lit(False).alias("deleted"))
    revise = counts.select(*base, "n_tokens", F.lit(False).alias("deleted"))
    first = with_group_min(counts.select("doc_id", "text_md5"), "text_md5", "doc_id", "first")
    copies = first.where("doc_id <> first").select("doc_id").join(counts, "doc_id")
    delete = copies.select(*base, "n_tokens", F.lit(True).alias("deleted"))
    for batch, changes in (("1-insert", insert), ("2-revise", revise), ("3-copies", delete), ("2-revise", revise)):
        rollup.commit(batch, changes)
    return rollup.totals()
