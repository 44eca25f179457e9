"""Polling ingestion as Structured Streaming jobs.

Every job is ``readStream`` -> ``foreachBatch`` with a checkpoint in the
shared checkpoint folder. The checkpoint names the stream and the micro-batch its
``batch_id``; the tables' manifest keeps the last batch of each stream. A committed
batch is skipped, and a half-applied one, which no reader has seen, is applied again.
So a restarted query (after a crash or lost executors) replays its last batch
without duplicating anything (T5). ``supervise`` restarts a failed query from
its checkpoint: the failed cycle is logged and the loop goes on.

* T1 ``start_ingest_stream``: processing-time trigger (default 15 minutes).
* T2 ``ingest_now``: ``availableNow`` on the same checkpoint, waits for the end.
* T3 ``ingest_full``: a fresh checkpoint (everything is read again); chunks are
  upserted, vectors of indexed documents are still skipped.
* T4 ``start_change_detection``: last ``modified_time`` per file id kept in a
  state table; each poll (micro-batch = one full listing) emits changed or new
  files and advances the state, committed after the output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import joins as J
from ..operators.store import SnapshotTable
from ..plans.ingest import IngestJob
from ..session import checkpoint_root

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def file_stream(
    spark: SparkSession, folder: str, schema: str, file_glob: str | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files of ``folder`` as a stream (explicit schema, no inference)."""
    r = spark.readStream.schema(schema).format("parquet")
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(folder)


def table_stream(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """S7 on a table of ``folder``, which is one Parquet file or a folder of them (``pathGlobFilter``
    sees only names of files, so it would pass over every part of such a folder)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(path).isDirectory():
        return file_stream(spark, path.toString(), schema)
    return file_stream(spark, folder, schema, file_glob=path.getName())


def _version_base(spark: SparkSession, checkpoint: str, current: int | None) -> int:
    """First snapshot version used by the query with this checkpoint (stable across restarts)."""
    path = f"{checkpoint}/version_base"
    try:
        return int(spark.read.parquet(path).first()["base"])
    except Exception as e:  # first start
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    base = (current + 1) if current is not None else 0
    spark.range(1).select(F.lit(base).alias("base")).write.mode("overwrite").parquet(path)
    return base


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{checkpoint}/query")
        .trigger(**trigger)
        .start()
    )


def start_ingest_stream(
    docs: DataFrame,
    job: IngestJob,
    checkpoint: str,
    trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Every trigger, ingest the new documents (``text, source, title``) with ``job``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        job.run(prepare(batch) if prepare else batch, batch_id, stream=checkpoint)

    return _start(docs, each, checkpoint, trigger or {"processingTime": "15 minutes"})


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until ``query`` has ended. A wait that expires stops the query and
    raises: what was committed so far is not the result."""
    ended = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    if ended is False:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not end within {timeout_s} s")
    if query.exception():
        raise query.exception()


def ingest_now(docs: DataFrame, job: IngestJob, checkpoint: str, prepare=None, timeout_s: int | None = None) -> None:
    """Process everything available now on the same checkpoint, then stop."""
    q = start_ingest_stream(docs, job, checkpoint, {"availableNow": True}, prepare)
    finish(q, timeout_s)


def ingest_full(docs: DataFrame, job: IngestJob, checkpoint_parent: str, prepare=None, timeout_s: int | None = None) -> str:
    """A new checkpoint (so every file is read again) on the same tables; returns it."""
    import uuid

    ckpt = f"{checkpoint_parent.rstrip('/')}/full-{uuid.uuid4().hex}"
    ingest_now(docs, job, ckpt, prepare, timeout_s)
    return ckpt


def start_change_detection(
    listing: DataFrame,
    state: SnapshotTable,
    out_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """T4: each micro-batch is one poll of the listing (``file_id, name, mime, modified_time``)."""
    spark = listing.sparkSession
    base = _version_base(spark, checkpoint, state.current_version())

    def each(batch: DataFrame, batch_id: int) -> None:
        version = base + batch_id
        done = state.current_version()
        if done is not None and done >= version:
            return
        rows = prepare(batch) if prepare else batch
        old = state.read(before=version)
        changed = J.changed_files(rows, old)
        changed.write.mode("overwrite").parquet(f"{out_root}/version={version}")
        fetched = spark.read.parquet(f"{out_root}/version={version}").select("file_id", "modified_time")
        state.write(J.advance_state(old, rows, fetched), version)

    return _start(listing, each, checkpoint, trigger or {"processingTime": "15 minutes"})


def stream_root(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{checkpoint_root(spark)}/corpusflow/streams/{name}-{uuid.uuid4().hex}"


def supervise(
    start: Callable[[], StreamingQuery], max_restarts: int | None = None, wait_s: float = 5.0, max_wait_s: float = 300.0, log=print
) -> StreamingQuery:
    """T1 "a failed cycle is logged and the loop goes on": run a streaming query and
    restart it from its checkpoint after every failure. The failed micro-batch is
    replayed, and the sinks are idempotent, so nothing is lost or doubled. The wait
    doubles with failures that made no progress in between. ``max_restarts`` (of
    such failures in a row) is off by default. Returns the query that ended."""
    import time

    failures = 0
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except Exception as e:  # the query died; its checkpoint keeps the progress
            moved = any(p["numInputRows"] for p in q.recentProgress)
            failures = 1 if moved else failures + 1
            log(f"stream {q.name or q.id} failed (attempt {failures}): {str(e)[:300]}")
            if max_restarts is not None and failures > max_restarts:
                raise
            time.sleep(min(wait_s * 2 ** (failures - 1), max_wait_s))
