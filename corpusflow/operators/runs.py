"""K1-K3, J5, J6 on stored tables whose write cost follows the batch: sorted delta runs.

A batch never rewrites older rows. It is written as one run: rows in hash buckets
of the first key column, sorted by key, and the document ids whose older rows it
takes away (tombstones). Readers merge the runs, newest wins. Runs of similar
size are merged later (``RunTable.compact``), so every row is rewritten about once
per doubling of the table, and a table of any size has few runs.

Each data file of a run has its key range and a Bloom filter in the run's index
table; ``lookup`` asks the index first and opens no file that cannot hold a key.

``RunLog`` holds the committed state, a list of runs per table. A state is created
only if its version is absent, so of two writers one comes second: it then looks
at what was committed meanwhile, goes on if those batches touched other key slots,
and otherwise runs its batch again on the new state.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import last_wins
from .store import CHUNK_KEYS

#: Rows of a data file, about; hash slots by which writers tell whether their batches met.
FILE_ROWS, SLOTS = 250_000, 1024
#: Two neighbouring runs are merged while the older has fewer than this many times the rows of the newer ones.
RATIO = 4
#: Bloom filters: bits per document, probes per document, bits of one stored bitmap (that of Spark's bitmap functions).
BITS, PROBES, BITMAP = 12, 4, 32_768
_STATE = "v={:012d}.json"


class Conflict(RuntimeError):
    """Another writer committed something this batch depends on."""


class RunLog:
    """Committed states of a group of ``RunTable``s under ``root`` in the shared file system."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 3, patience: float = 30.0):
        self.spark, self.root, self.keep, self.patience = spark, root.rstrip("/"), keep, patience
        self._jvm = spark.sparkContext._jvm

    def path(self, rel: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{rel}")

    def fs(self):
        return self.path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self.path("states")
        names = [s.getPath().getName() for s in self.fs().listStatus(folder)] if self.fs().exists(folder) else []
        return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json"))

    def _read(self, version: int) -> dict | None:
        """The state of a version; None while its writer has not finished it."""
        stream = self.fs().open(self.path(f"states/{_STATE.format(version)}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text.endswith("}\n") else None

    def load(self) -> dict:
        """The newest finished state; before the first commit an empty one."""
        for version in reversed(self.versions()):
            if (state := self._read(version)) is not None:
                return state
        return {"version": -1, "applied": {}, "tables": {}, "batches": []}

    def _create(self, version: int, text: str) -> bool:
        """Write a state if its version is absent; False if another writer has it."""
        path = self.path(f"states/{_STATE.format(version)}")
        fs, plain = self.fs(), path.toUri().getPath()
        errors = ("FileAlreadyExists",)
        try:
            fs.mkdirs(path.getParent())
            if fs.getUri().getScheme() == "file":  # there, Hadoop's create looks first and then writes: not one step
                nio = self._jvm.java.nio.file
                nio.Files.createFile(nio.Paths.get(plain, self.spark.sparkContext._gateway.new_array(self._jvm.java.lang.String, 0)),
                                     self.spark.sparkContext._gateway.new_array(nio.attribute.FileAttribute, 0))
                out = fs.create(path, True)
            else:
                out = fs.create(path, False)
        except Exception as e:
            if any(x in str(e) for x in errors):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def commit(self, change: Callable[[dict], dict | None]) -> dict | None:
        """Create the next state. ``change`` makes it out of the newest one, as often as other
        writers come first; it returns None if there is nothing to do and may raise ``Conflict``."""
        began = time.time()
        while True:
            now = self.load()
            new = change(now)
            if new is None:
                return None
            new["version"] = now["version"] + 1
            if self._create(new["version"], json.dumps(new) + "\n"):
                self._clean(new)
                return new
            if self.load()["version"] < new["version"]:  # taken, not finished: its writer is at it, or died
                if time.time() - began > self.patience:
                    raise RuntimeError(f"{self.root}: version {new['version']} was begun and never finished; remove that file if its writer is gone")
                time.sleep(0.05)

    def _clean(self, state: dict) -> None:
        """Remove states before the last ``keep``, and runs that only those name. Folders that no
        state names may belong to a writer at work and stay."""
        versions = self.versions()
        old, kept = [v for v in versions if v <= state["version"] - self.keep], [v for v in versions if v > state["version"] - self.keep]
        named = lambda vs: {(t, r["id"]) for v in vs if (s := self._read(v)) for t, runs in s["tables"].items() for r in runs}
        try:
            gone = named(old) - named(kept)
            for v in old:
                self.fs().delete(self.path(f"states/{_STATE.format(v)}"), False)
            for table, run in gone:
                self.fs().delete(self.path(f"{table}/{run}"), True)
        except Exception as e:  # another writer cleaned first
            if "FileNotFound" not in str(e):
                raise


def applied(state: dict, stream: str, batch: int) -> bool:
    """Batch numbers of one stream only grow, so its last one tells about all."""
    return batch <= state["applied"].get(stream, -1)


class RunTable:
    """A keyed table of sorted runs; ``keys[0]`` is the column of buckets, tombstones and lookups."""

    def __init__(self, log: RunLog, name: str, schema: T.StructType, keys: tuple[str, ...], file_rows: int = FILE_ROWS):
        self.log, self.spark, self.name, self.schema, self.keys, self.file_rows = log, log.spark, name, schema, keys, file_rows
        self.doc = keys[0]

    def runs(self, state: dict | None = None) -> list[dict]:
        return (state or self.log.load())["tables"].get(self.name, [])

    def _folder(self, run: dict, part: str) -> str:
        return f"{self.log.root}/{self.name}/{run['id']}/{part}"

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.doc), F.lit(buckets)).cast("int")

    # -- writing --------------------------------------------------------------------------------

    def write(self, rows: DataFrame | None, gone: DataFrame | None = None, n_rows: int | None = None) -> dict:
        """Write a run that no state names yet: ``rows`` (a repeated key raises) and the ids in
        ``gone`` whose rows in older runs go. ``n_rows``: a known bound of the row count."""
        run = {"id": uuid.uuid4().hex, "rows": 0, "gone": 0, "buckets": 1}
        slots: set[int] = set()
        if rows is not None:
            n_rows = rows.count() if n_rows is None else n_rows
            run["buckets"] = 1 << max(0, -(-n_rows // self.file_rows) - 1).bit_length()
            laid = rows.select(*self.schema.fieldNames()).withColumn("bucket", self._bucket(run["buckets"]))
            laid.repartitionById(run["buckets"], "bucket").sortWithinPartitions("bucket", *self.keys).write.partitionBy("bucket").parquet(self._folder(run, "rows"))
            slots |= self._index(run)
        if gone is not None:
            slot = F.pmod(F.xxhash64(self.doc, F.lit("slot")), F.lit(SLOTS)).cast("int")
            ids = gone.select(self.doc).where(F.col(self.doc).isNotNull()).distinct().withColumn("slot", slot)
            ids.write.parquet(self._folder(run, "gone"))
            of_slots = self.spark.read.parquet(self._folder(run, "gone")).groupBy("slot").count().collect()  # at most ``SLOTS`` rows
            run["gone"] = sum(r["count"] for r in of_slots)
            slots |= {r["slot"] for r in of_slots}
        run["bytes"] = self.log.fs().getContentSummary(self.log.path(f"{self.name}/{run['id']}")).getLength()
        run["slots"] = sorted(slots)
        return run

    def _index(self, run: dict) -> set[int]:
        """Write the index of a run's files, and give the slots of its documents: per bucket the rows,
        key range and slots, and its Bloom filter (one row per bitmap)."""
        rows = self._rows(run, with_bucket=True).groupBy("bucket", *self.keys).agg(F.count(F.lit(1)).alias("n"))
        slot = F.pmod(F.xxhash64(self.doc, F.lit("slot")), F.lit(SLOTS)).cast("int")
        docs = rows.groupBy("bucket", self.doc).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
        per_file = docs.groupBy("bucket").agg(
            F.sum("n").alias("rows"), F.max("most").alias("most"), F.min(self.doc).alias("low"), F.max(self.doc).alias("high"),
            F.ceil(F.count(F.lit(1)) * F.lit(BITS) / BITMAP).cast("int").alias("bitmaps"), F.collect_set(slot).alias("slots"))
        at = docs.join(per_file.select("bucket", "bitmaps"), "bucket").select("bucket", F.explode(self._probes(F.col("bitmaps"))).alias("at"))
        bits = at.groupBy("bucket", (F.col("at") / BITMAP).cast("int").alias("bitmap")).agg(
            F.bitmap_construct_agg((F.col("at") % BITMAP).cast("long")).alias("bits"))
        per_file.join(bits, "bucket").write.parquet(self._folder(run, "index"))
        index = self.spark.read.parquet(self._folder(run, "index")).groupBy("bucket").agg(
            F.first("rows").alias("rows"), F.first("most").alias("most"), F.first("slots").alias("slots"))
        files = index.agg(F.sum("rows").alias("rows"), F.max("most").alias("most"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots")).first()
        if (files["most"] or 0) > 1:
            self.log.fs().delete(self.log.path(f"{self.name}/{run['id']}"), True)
            raise ValueError(f"{self.name}: the batch repeats a key")
        run["rows"] = files["rows"] or 0
        return set(files["slots"] or [])

    def _probes(self, bitmaps: Column) -> Column:
        """Positions of a document in a Bloom filter of ``bitmaps`` bitmaps."""
        return F.array(*[F.pmod(F.xxhash64(self.doc, F.lit(k)), bitmaps.cast("long") * BITMAP) for k in range(PROBES)])

    # -- reading --------------------------------------------------------------------------------

    def _rows(self, run: dict, buckets: list[int] | None = None, with_bucket: bool = False) -> DataFrame:
        """Rows of a run, of all its buckets or of those listed (no other folder is opened)."""
        shape = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        folder = self._folder(run, "rows")
        paths = [folder] if buckets is None else [f"{folder}/bucket={b}" for b in buckets]
        rows = self.spark.read.schema(shape).option("basePath", folder).parquet(*paths)
        return rows if with_bucket else rows.drop("bucket")

    def _live(self, parts: list[tuple[DataFrame | None, DataFrame | None]]) -> DataFrame:
        """Newest-wins merge of runs, oldest first. Older rows leave by anti joins with the keys and
        tombstones of newer runs: AQE broadcasts those when they are small, so the large old run stays in place."""
        live = []
        for k, (rows, _) in enumerate(parts):
            if rows is None:
                continue
            newer = [r.select(*self.keys) for r, _ in parts[k + 1:] if r is not None]
            gone = [g for _, g in parts[k + 1:] if g is not None]
            if newer:
                rows = rows.join(reduce(DataFrame.unionByName, newer), list(self.keys), "left_anti")
            if gone:
                rows = rows.join(reduce(DataFrame.unionByName, gone), self.doc, "left_anti")
            live.append(rows.select(*self.schema.fieldNames()))
        return reduce(DataFrame.unionByName, live) if live else self.spark.createDataFrame([], self.schema)

    def _gone(self, run: dict) -> DataFrame | None:
        return self.spark.read.parquet(self._folder(run, "gone")).select(self.doc) if run["gone"] else None

    def read(self, state: dict | None = None) -> DataFrame:
        """All live rows of the newest (or given) state."""
        return self._live([(self._rows(r) if r["rows"] else None, self._gone(r)) for r in self.runs(state)])

    def candidates(self, ids: DataFrame, state: dict | None = None) -> dict[str, list[int]]:
        """Buckets, by run, whose key range and Bloom filter admit one of the document ids."""
        asked = ids.select(self.doc).where(F.col(self.doc).isNotNull()).distinct()
        found = []
        for run in (r for r in self.runs(state) if r["rows"]):
            index = self.spark.read.parquet(self._folder(run, "index"))
            files = index.select("bucket", "low", "high", "bitmaps").distinct()
            probes = asked.withColumn("bucket", self._bucket(run["buckets"])).join(files, "bucket").where(F.col(self.doc).between(F.col("low"), F.col("high")))
            at = probes.select("bucket", self.doc, F.explode(self._probes(F.col("bitmaps"))).alias("at"))
            at = at.withColumn("bitmap", (F.col("at") / BITMAP).cast("int"))
            byte = F.conv(F.hex(F.substring("bits", ((F.col("at") % BITMAP) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            hit = F.getbit(byte, (F.col("at") % 8).cast("int")) == 1
            tested = at.join(index.select("bucket", "bitmap", "bits"), ["bucket", "bitmap"], "left").select("bucket", self.doc, F.coalesce(hit, F.lit(False)).alias("hit"))
            held = tested.groupBy("bucket", self.doc).agg(F.bool_and("hit").alias("held")).where("held")
            found.append(held.select(F.lit(run["id"]).alias("run"), "bucket").distinct())
        out: dict[str, list[int]] = {}
        if found:
            for r in reduce(DataFrame.unionByName, found).collect():  # at most one row per data file
                out.setdefault(r["run"], []).append(r["bucket"])
        return out

    def lookup(self, ids: DataFrame, state: dict | None = None) -> DataFrame:
        """Live rows that equal a row of ``ids`` in its columns (the first key column is one of
        them); only files whose index admits one of the ids are opened."""
        state = state or self.log.load()
        held = self.candidates(ids, state)
        parts = [(self._rows(r, sorted(held[r["id"]])) if r["id"] in held else None, self._gone(r)) for r in self.runs(state)]
        columns = [c for c in self.keys if c in ids.columns]
        return self._live(parts).join(ids.select(*columns).distinct(), columns, "left_semi")

    # -- merging runs ---------------------------------------------------------------------------

    def due(self, runs: list[dict], ratio: int = RATIO) -> int:
        """Place of the first run to merge with all newer ones; the last place if none is due."""
        size = [r["rows"] + r["gone"] for r in runs]
        first = len(runs) - 1
        for k in range(len(runs) - 2, -1, -1):
            if size[k] < ratio * sum(size[k + 1:]):
                first = k
        return first

    def compact(self, ratio: int = RATIO) -> bool:
        """Merge the newest runs into one where the size rule asks for it; False if it does not.
        Batches that other writers commit meanwhile stay after the merged run."""
        state = self.log.load()
        runs = self.runs(state)
        first = self.due(runs, ratio)
        if first >= len(runs) - 1:
            return False
        merged = runs[first:]
        rows = self._live([(self._rows(r) if r["rows"] else None, self._gone(r)) for r in merged])
        gone = [g for r in merged if (g := self._gone(r)) is not None] if first else []  # nothing is older: tombstones end here
        new = self.write(rows, reduce(DataFrame.unionByName, gone) if gone else None, n_rows=sum(r["rows"] for r in merged))
        new["slots"] = []  # a merge changes no row

        def change(now: dict) -> dict:
            here, ids = self.runs(now), [r["id"] for r in merged]
            at = next((k for k, r in enumerate(here) if r["id"] == ids[0]), -1)
            if at < 0 or [r["id"] for r in here[at : at + len(ids)]] != ids:
                raise Conflict(f"{self.name}: the runs were merged by another writer")
            return now | {"tables": now["tables"] | {self.name: [*here[:at], new, *here[at + len(ids):]]}}

        try:
            self.log.commit(change)
        except Conflict:
            return False
        return True


def append(log: RunLog, base: dict, new: dict[str, dict], stream: str, batch: int) -> dict | None:
    """Commit one batch's runs (by table name), made on the state ``base``, to all their tables at
    once. None if the batch is applied already; raises ``Conflict`` if a batch committed since
    ``base`` touched one of the same key slots."""
    known = {r["id"] for runs in base["tables"].values() for r in runs}
    mine = {name: set(run["slots"]) for name, run in new.items()}

    def change(now: dict) -> dict | None:
        if applied(now, stream, batch):
            return None
        for name, slots in mine.items():
            for run in now["tables"].get(name, []):
                if run["id"] not in known and not slots.isdisjoint(run["slots"]):
                    raise Conflict(f"{name}: another batch touched the same keys")
        tables = now["tables"] | {name: [*now["tables"].get(name, []), run] for name, run in new.items() if run["rows"] or run["gone"]}
        return now | {"tables": tables, "applied": now["applied"] | {stream: batch}}

    return log.commit(change)


def retried(job: Callable[[], DataFrame | dict | None], times: int = 20):
    """Run ``job`` again after each ``Conflict``: it reads the state anew."""
    for left in range(times, 0, -1):
        try:
            return job()
        except Conflict:
            if left == 1:
                raise


def upsert_chunk_run(table: RunTable, batch: DataFrame, now: Column, batch_id: int, stream: str = "batch", seq: str | None = "seq") -> bool:
    """K1 as a delta run: text, source and title of the batch's keys are replaced, ``created_at`` of
    keys that the table has stays. Of repeated keys the highest ``seq`` wins; without ``seq`` they raise."""
    if seq and seq in batch.columns:
        batch = last_wins(batch, CHUNK_KEYS, seq).drop(seq)

    def job() -> bool:
        state = table.log.load()
        if applied(state, stream, batch_id):
            return False
        run = table.write(with_created_at(table, batch, now, state))
        return append(table.log, state, {table.name: run}, stream, batch_id) is not None

    return retried(job)


def with_created_at(table: RunTable, batch: DataFrame, now: Column, state: dict) -> DataFrame:
    """The batch's rows; ``created_at`` from the stored rows of their keys, found through the index."""
    rows = batch.withColumn("title", F.coalesce("title", F.lit("")))
    if not any(r["rows"] for r in table.runs(state)):
        return rows.withColumn("created_at", now)
    old = table.lookup(rows.select(*CHUNK_KEYS), state).select(*CHUNK_KEYS, F.col("created_at").alias("_old"))
    return rows.join(old, list(CHUNK_KEYS), "left").withColumn("created_at", F.coalesce("_old", now)).drop("_old")


def delete_run(tables: Iterable[RunTable], ids: DataFrame, batch_id: int, stream: str = "batch") -> bool:
    """K2 as tombstones: every row of the listed documents goes from all ``tables`` (of one log) at once."""
    tables = list(tables)
    log = tables[0].log

    def job() -> bool:
        state = log.load()
        if applied(state, stream, batch_id):
            return False
        return append(log, state, {t.name: t.write(None, ids) for t in tables}, stream, batch_id) is not None

    return retried(job)
