"""D2 over delta runs: an ingest whose every batch writes what it changes and no more.

The steps are those of ``plans.ingest`` (document ids, chunks, index check,
embedding, points); chunks and points are ``RunTable``s of one ``RunLog``, so a
batch appears in both or in neither, several jobs may write at the same time, and
the work of a batch follows its own size: stored rows are met through the index
(``created_at`` of known chunks, documents that have points), never rewritten.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import runs as R
from ..operators import store as K
from ..session import checkpoint_root
from .ingest import POINT_SCHEMA, chunk_rows, embed_points, prepare_documents

POINT_RUN_KEYS = ("doc_id", "collection", "chunk_id")


class DeltaIngest:
    """Chunk and point tables as delta runs under ``root`` (the shared checkpoint folder by default)."""

    def __init__(self, spark: SparkSession, root: str | None = None, model: str = "hashing", dim: int = 64, ratio: int = R.RATIO):
        self.spark, self.model, self.dim, self.ratio = spark, model, dim, ratio
        self.root = (root or f"{checkpoint_root(spark)}/corpusflow/deltas").rstrip("/")
        self.log = R.RunLog(spark, self.root)
        self.chunk_table = R.RunTable(self.log, "chunks", K.CHUNK_SCHEMA, K.CHUNK_KEYS)
        self.point_table = R.RunTable(self.log, "points", POINT_SCHEMA, POINT_RUN_KEYS)

    def run(self, docs: DataFrame, batch_id: int, now: Column | None = None, stream: str = "batch") -> bool:
        """Ingest one batch (``text, source, title[, collection][, seq]``) once; False if it is applied
        already. Documents with one source in one collection: the greatest ``seq`` wins, then a hash of
        the text; a document in several collections has its chunks stored once and points in each."""
        now = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp") if now is None else now
        if R.applied(self.log.load(), stream, batch_id):
            return False
        prepared = prepare_documents(docs).where(F.col("text") != "")
        order = F.struct(*[c for c in ("seq",) if c in prepared.columns], F.xxhash64("text"))
        ids = prepared.groupBy("collection", "doc_id").count().agg(F.max("count")).first()[0]
        if (ids or 0) > 1:  # texts are shuffled only where documents collide
            prepared = A.last_wins(prepared.withColumn("_order", order), ("collection", "doc_id"), "_order").drop("_order")
        staging = f"staging/{uuid.uuid4().hex}"
        chunk_rows(prepared.drop("seq")).write.parquet(f"{self.root}/{staging}")  # the splitter runs once
        staged = self.spark.read.parquet(f"{self.root}/{staging}")
        one = staged.where("chunk_id = 0").groupBy("doc_id").agg(F.min("collection").alias("collection"))
        stored_once = staged.join(one, ["doc_id", "collection"], "left_semi").select("doc_id", "chunk_id", "text", "source", "title")

        n = staged.count()

        def job() -> bool:
            state = self.log.load()
            if R.applied(state, stream, batch_id):
                return False
            chunks = self.chunk_table.write(R.with_created_at(self.chunk_table, stored_once, now, state), n_rows=n)
            known = self.point_table.lookup(staged.select("doc_id").distinct(), state).select("collection", "doc_id").distinct()
            todo = staged.join(known, ["collection", "doc_id"], "left_anti")
            points = self.point_table.write(embed_points(todo, now, self.model, self.dim), n_rows=n)
            return R.append(self.log, state, {"chunks": chunks, "points": points}, stream, batch_id) is not None

        done = R.retried(job)
        self.log.fs().delete(self.log.path(staging), True)
        return done

    def delete_documents(self, doc_ids: DataFrame, batch_id: int, stream: str = "batch") -> bool:
        """K2: the listed documents go from both tables in one commit."""
        return R.delete_run((self.chunk_table, self.point_table), doc_ids, batch_id, stream)

    def compact(self) -> list[str]:
        """Merge runs where the size rule asks for it; names of the tables that were merged."""
        return [t.name for t in (self.chunk_table, self.point_table) if t.compact(self.ratio)]

    def chunks(self) -> DataFrame:
        return self.chunk_table.read()

    def points(self) -> DataFrame:
        return self.point_table.read()
