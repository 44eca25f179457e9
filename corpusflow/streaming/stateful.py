"""T4 as keyed streaming state: the last ``modified_time`` per file id.

``transformWithStateInPandas`` keeps one value per file id in the state store
(RocksDB); each poll of the listing emits the files that are new or whose
modified time differs, and updates the state. The saved state of a previous
run enters as ``initialState``. With ``forget_after`` a file that no poll has
listed for so many seconds (a number of poll intervals) leaves the state by its
time to live: the store does not grow with deleted files, and one that comes back
is new again. ``state_snapshot`` reads the state of a checkpoint back as a table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT_SCHEMA = "file_id string, name string, modified_time string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# the Python process beside the driver that sets up the state does not see shipped packages:
# the processor travels whole, not by the name of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LastModified(StatefulProcessor):
    def __init__(self, forget_after: float | None = None):
        self.ttl = None if forget_after is None else int(forget_after * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        # every listing of a file writes its state anew, which is when its time to live begins again
        self.last = handle.getValueState("last_modified", "modified_time string", self.ttl)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.last.update((initialState["modified_time"].iloc[-1],))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.exists()
        prev = self.last.get()[0] if known else None
        out = []
        for pdf in rows:
            for name, mtime in zip(pdf["name"], pdf["modified_time"]):
                mtime = None if pd.isna(mtime) else mtime
                if not known or prev != mtime:
                    out.append((key[0], name, mtime))
                known, prev = True, mtime
        if known:
            self.last.update((prev,))
        if out:
            yield pd.DataFrame(out, columns=["file_id", "name", "modified_time"])

    def close(self) -> None:
        pass


def changed_files_stateful(listing: DataFrame, initial_state: DataFrame | None = None, forget_after: float | None = None) -> DataFrame:
    """Streaming ``file_id, name, modified_time`` of changed files (append mode); files that were not
    listed for ``forget_after`` seconds are forgotten (``None``: never)."""
    spark = listing.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if forget_after is not None:
        # state with a time to live would run batches without data for ever; a poll always has data
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    init = initial_state.groupBy("file_id") if initial_state is not None else None
    return listing.select("file_id", "name", "modified_time").groupBy("file_id").transformWithStateInPandas(
        statefulProcessor=LastModified(forget_after),
        outputStructType=OUTPUT_SCHEMA,
        outputMode="Append",
        timeMode="None" if forget_after is None else "ProcessingTime",
        initialState=init,
    )


def state_snapshot(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """S8 out of a stream: ``file_id, modified_time`` as the checkpoint's newest (or given) batch left them."""
    reader = spark.read.format("statestore").option("stateVarName", "last_modified")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    state = reader.load(checkpoint)
    if "ttlExpirationMs" in state.schema["value"].dataType.names:  # the value lies beside the end of its time to live
        alive = F.col("value.ttlExpirationMs") > F.unix_millis(F.current_timestamp())
        state = state.where(alive).select("key", F.col("value.value").alias("value"))
    return state.select(F.col("key.file_id").alias("file_id"), F.col("value.modified_time").alias("modified_time"))
