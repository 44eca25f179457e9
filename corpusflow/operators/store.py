"""K1-K7: keyed tables as pure ``(old, batch) -> new`` functions, plus snapshot I/O.

Built-in Parquet tables have no MERGE, so an upsert is a full outer join on
the key followed by a write of a new snapshot. A snapshot is committed by a
marker written after its data, so readers never see a half-written version
and a failed job (lost executors included) leaves only an ignored folder;
re-running the same batch writes the same rows (ids are deterministic).

Large tables (``KeyedTable``) rewrite only the key buckets a batch touches, into
a new version folder; a manifest renamed into place commits them (``Manifest``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import migrate_created_at
from .aggregates import last_wins, merge_source_types

CHUNK_KEYS = ("doc_id", "chunk_id")
POINT_KEYS = ("collection", "point_id")

CHUNK_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("chunk_id", T.IntegerType(), False),
    T.StructField("text", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("source_types", T.ArrayType(T.StringType()), False),
    T.StructField("updated_at", T.TimestampType(), False),
])


def _checked(batch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``batch`` with ``_new`` = true; a repeated key raises, as the join would multiply its rows.
    The window needs the same partitions and order as the join after it: no extra shuffle."""
    twice = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    fail = F.raise_error(F.lit(f"repeated key {', '.join(keys)} in the batch")).cast("boolean")
    return batch.withColumn("_twice", twice).withColumn("_new", F.when(F.col("_twice"), fail).otherwise(F.lit(True))).drop("_twice")


def upsert_chunks(old: DataFrame, batch: DataFrame, now: Column, seq: str | None = "seq") -> DataFrame:
    """K1: replace text/source/title of batch keys, keep ``created_at`` of existing rows,
    keep rows not in the batch. Duplicate keys in the batch: the highest ``seq`` wins (W2);
    without ``seq`` they raise."""
    if seq and seq in batch.columns:
        batch = last_wins(batch, CHUNK_KEYS, seq).drop(seq)
    b = _checked(batch, CHUNK_KEYS).select(
        *CHUNK_KEYS, F.col("text").alias("_t"), F.col("source").alias("_s"),
        F.coalesce(F.col("title"), F.lit("")).alias("_ti"), "_new",
    )
    j = old.join(b, list(CHUNK_KEYS), "full_outer")
    isnew = F.col("_new").isNotNull()
    return j.select(
        *CHUNK_KEYS,
        F.when(isnew, F.col("_t")).otherwise(F.col("text")).alias("text"),
        F.when(isnew, F.col("_s")).otherwise(F.col("source")).alias("source"),
        F.when(isnew, F.col("_ti")).otherwise(F.col("title")).alias("title"),
        F.coalesce(F.col("created_at"), now).alias("created_at"),
    )


def delete_docs(chunks: DataFrame, doc_ids: DataFrame, doc: str = "doc_id") -> DataFrame:
    """K2: drop all chunks of the listed documents."""
    return chunks.join(doc_ids.select(doc), doc, "left_anti")


def upsert_points(old: DataFrame, batch: DataFrame, keys: tuple[str, ...] = POINT_KEYS, checked: bool = False) -> DataFrame:
    """K3: points replaced whole (vector and payload) by key; others kept. With ``checked``
    (the stored tables) a repeated key in the batch raises."""
    cols = [c for c in old.columns if c not in keys]
    batch = _checked(batch, keys) if checked else batch.withColumn("_new", F.lit(True))
    b = batch.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols], "_new")
    j = old.join(b, list(keys), "full_outer")
    isnew = F.col("_new").isNotNull()
    return j.select(*keys, *[F.when(isnew, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def register_collections(registry: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """K4: insert new collection rows, merge source types of existing ones (A2), stamp ``updated_at``."""
    b = batch.select(F.col("name"), F.col("source_types").alias("_new"))
    j = registry.join(b, "name", "full_outer")
    touched = F.col("_new").isNotNull()
    return j.select(
        "name",
        F.when(touched, merge_source_types(F.col("source_types"), F.col("_new"))).otherwise(F.col("source_types")).alias("source_types"),
        F.when(touched, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def ensure_chunk_schema(df: DataFrame) -> DataFrame:
    """K6: bring an older snapshot to the current schema: ``title`` defaults to '',
    text ``created_at`` becomes a timestamp ('' / NULL -> epoch, F8)."""
    if "title" not in df.columns:
        df = df.withColumn("title", F.lit(""))
    if "source" not in df.columns:
        df = df.withColumn("source", F.lit(""))
    ca = dict(df.dtypes).get("created_at")
    if ca is None:
        df = df.withColumn("created_at", F.to_timestamp(F.lit("1970-01-01T00:00:00Z")))
    elif ca == "string":
        df = df.withColumn("created_at", migrate_created_at("created_at"))
    return df.select(
        "doc_id", F.col("chunk_id").cast("int").alias("chunk_id"), "text",
        F.coalesce("source", F.lit("")).alias("source"), F.coalesce("title", F.lit("")).alias("title"), "created_at",
    )


def route_collections(docs: DataFrame, routes: DataFrame, on: str = "lang", default: str | None = None) -> DataFrame:
    """K7: a ``collection`` column per document; a document routed to several
    collections appears once per target. The rules table (one row per rule) is
    broadcast after a bounded row count confirms it is small."""
    from ..session import broadcast_if_small

    r = routes.groupBy(on).agg(F.array_sort(F.collect_set("collection")).alias("_targets"))
    j = docs.join(broadcast_if_small(r), on, "left")
    targets = F.coalesce(F.col("_targets"), F.array(F.lit(default)) if default else F.array().cast("array<string>"))
    return j.withColumn("collection", F.explode(targets)).drop("_targets")


# -- snapshot tables ------------------------------------------------------------------------

class SnapshotTable:
    """Versioned Parquet table under a shared folder: ``data/v=N`` then ``commits/v=N``.

    ``partition_by`` lays out each version by a column (e.g. ``collection``).
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, partition_by: tuple[str, ...] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by

    def committed_versions(self) -> list[int]:
        """Versions with a commit marker: a listing of ``commits/`` through the
        Hadoop file system of the session (works for any shared store), no job."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
        return sorted(out)

    def current_version(self, before: int | None = None) -> int | None:
        """Latest committed version (only versions < ``before`` when given)."""
        vs = [v for v in self.committed_versions() if before is None or v < before]
        return vs[-1] if vs else None

    def read(self, before: int | None = None) -> DataFrame:
        """The latest committed snapshot (the one before version ``before`` when replaying)."""
        v = self.current_version(before)
        if v is None:
            if self.schema is None:
                raise FileNotFoundError(self.root)
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(f"{self.root}/data/v={v}")

    def write(self, df: DataFrame, version: int | None = None) -> int:
        cur = self.current_version()
        v = (cur + 1 if cur is not None else 0) if version is None else version
        w = df.write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(f"{self.root}/data/v={v}")
        self.mark(v)
        return v

    def mark(self, version: int) -> None:
        """Commit marker: an empty ``commits/v=N/_SUCCESS`` created through the
        session's Hadoop file system (after the data is fully written)."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/v={version}/_SUCCESS")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.create(path, True).close()


class Manifest:
    """The committed state of a group of ``KeyedTable``s: one small JSON file per commit.

    It names, per table, the key, the bucket count and the version folder of every
    bucket, and per stream the last batch applied. All data of a commit is written
    before it, and it appears by a rename: readers see every table of a batch or
    none, and a crash anywhere leaves the previous state untouched. One writer at a time.
    The last ``keep`` states stay readable; older data folders are removed.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep

    def _path(self, rel: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{rel}")

    def _fs(self):
        return self._path("manifests").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, rel: str) -> list[str]:
        """Names in a folder of the group (none if it is not there)."""
        path = self._path(rel)
        return [st.getPath().getName() for st in self._fs().listStatus(path)] if self._fs().exists(path) else []

    def remove(self, rel: str) -> None:
        self._fs().delete(self._path(rel), True)

    def versions(self) -> list[int]:
        return sorted(int(n[2:-5]) for n in self.names("manifests") if n.startswith("v=") and n.endswith(".json"))

    def load(self, version: int | None = None) -> dict:
        """The newest state (or that of ``version``); before the first commit an empty one."""
        if version is None:
            found = self.versions()
            if not found:
                return {"version": -1, "applied": {}, "tables": {}}
            version = found[-1]
        stream = self._fs().open(self._path(f"manifests/v={version}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    @staticmethod
    def applied(state: dict, stream: str, batch: int) -> bool:
        """Batch numbers of one stream only grow, so its last one tells about all."""
        return batch <= state["applied"].get(stream, -1)

    def commit(self, state: dict, tables: dict[str, dict], stream: str, batch: int) -> int:
        """Make staged ``tables`` the state after ``state``; returns its version."""
        version = state["version"] + 1
        new = {
            "version": version,
            "applied": state["applied"] | {stream: batch},
            "tables": state["tables"] | tables,
        }
        hidden = f"manifests/_{uuid.uuid4().hex}"
        out = self._fs().create(self._path(hidden), True)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        if not self._fs().rename(self._path(hidden), self._path(f"manifests/v={version}.json")):
            raise RuntimeError(f"{self.root}: version {version} was committed by another writer")
        self._clean()
        return version

    def _clean(self) -> None:
        versions = self.versions()
        kept = [self.load(v) for v in versions[-self.keep:]]
        for v in versions[:-self.keep]:
            self.remove(f"manifests/v={v}.json")
        for table in kept[-1]["tables"]:
            live = {(v, int(b)) for st in kept for b, v in st["tables"].get(table, {"current": {}})["current"].items()}
            for folder in self.names(table):
                v = int(folder.removeprefix("v="))
                if v > versions[-1]:
                    continue
                if not any(x == v for x, _ in live):
                    self.remove(f"{table}/{folder}")
                    continue
                for bucket in self.names(f"{table}/{folder}"):
                    if bucket.startswith("bucket=") and (v, int(bucket[7:])) not in live:
                        self.remove(f"{table}/{folder}/{bucket}")


class KeyedTable:
    """Upsert target laid out as hash buckets of a key column:
    ``<name>/v=<version>/bucket=<n>``, optionally under further partition columns.

    An upsert reads only the buckets its batch touches, merges them with the
    batch and writes them to a new version folder; the manifest then points those
    buckets to it. So a batch costs the size of its buckets, not the table, and
    readers and crashes never meet half-written rows. A replay of a committed batch is a
    no-op. The bucket count is stored with the table: opening it with another one
    raises, ``rebucket`` changes it. Tables that share a ``Manifest`` commit together
    (``stage`` each, then ``Manifest.commit``).
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, bucket_key: str, buckets: int | None = None,
        partition_by: tuple[str, ...] = (), manifest: Manifest | None = None, name: str = "data",
    ):
        self.spark = spark
        self.schema = schema
        self.bucket_key = bucket_key
        self.partition_by = partition_by
        self.manifest = manifest or Manifest(spark, root)
        self.name = name
        state = self._state()
        if state and (state["key"] != bucket_key or buckets not in (None, state["buckets"])):
            raise ValueError(
                f"{self.data} has {state['buckets']} buckets of {state['key']}, not {buckets} of {bucket_key}; rebucket it first"
            )
        self.buckets = state["buckets"] if state else buckets or 64

    @property
    def data(self) -> str:
        return f"{self.manifest.root}/{self.name}"

    def _state(self) -> dict | None:
        return self.manifest.load()["tables"].get(self.name)

    def bucket_col(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.bucket_key)), F.lit(self.buckets)).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """Committed rows, of all buckets or of those listed (no other folder is opened)."""
        current = (self._state() or {"current": {}})["current"]
        paths = [f"{self.data}/v={v}/bucket={b}" for b, v in current.items() if buckets is None or int(b) in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        laid_out = T.StructType(self.schema.fields + [T.StructField(c, T.IntegerType()) for c in ("v", "bucket")])
        return self.spark.read.schema(laid_out).option("basePath", self.data).parquet(*paths).select(*self.schema.fieldNames())

    def holds(self, buckets: list[int]) -> bool:
        """Whether one of the buckets has committed rows."""
        return not {str(b) for b in buckets}.isdisjoint((self._state() or {"current": {}})["current"])

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows whose columns equal a row of ``keys`` (which has the bucket key); reads the buckets of ``keys`` only."""
        return self.read(self.touched(keys)).join(keys.distinct(), keys.columns, "left_semi")

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets of a batch: at most ``buckets`` small ints."""
        return sorted(r[0] for r in batch.select(self.bucket_col().alias("b")).distinct().collect())

    def stage(self, batch: DataFrame, merge, version: int, touched: list[int] | None = None) -> dict:
        """Write ``merge(old rows of the touched buckets, batch)`` as ``version``; returns the table's
        state for ``Manifest.commit``. Buckets that end up empty leave the state."""
        current = dict((self._state() or {"current": {}})["current"])
        touched = self.touched(batch) if touched is None else touched
        if touched:
            parts = ["bucket", *self.partition_by]
            merged = merge(self.read(touched), batch).select(*self.schema.fieldNames()).withColumn("bucket", self.bucket_col())
            # rows of a bucket meet in few tasks (no small files); the rebalance hint lets
            # AQE split a bucket that holds a hot document over several writers
            merged.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(f"{self.data}/v={version}")
            written = {n[7:] for n in self.manifest.names(f"{self.name}/v={version}") if n.startswith("bucket=")}
            if not written <= {str(b) for b in touched}:
                raise ValueError(f"{self.data}: rows outside the touched buckets")
            current = {b: v for b, v in current.items() if int(b) not in touched} | {b: version for b in written}
        return {"key": self.bucket_key, "buckets": self.buckets, "current": current}

    def upsert(self, batch: DataFrame, merge, batch_id: int, touched: list[int] | None = None, stream: str = "batch") -> bool:
        """Stage and commit one batch of this table alone; False if it is applied already."""
        state = self.manifest.load()
        if Manifest.applied(state, stream, batch_id):
            return False
        staged = self.stage(batch, merge, state["version"] + 1, touched)
        self.manifest.commit(state, {self.name: staged}, stream, batch_id)
        return True

    def delete(self, keys: DataFrame, batch_id: int, stream: str = "batch") -> bool:
        """K2 on the stored table: drop every row whose bucket key is listed in ``keys``
        (e.g. all chunks of some documents); only their buckets are rewritten."""
        return self.upsert(keys.select(self.bucket_key).distinct(), self.without, batch_id, stream=stream)

    def without(self, old: DataFrame, keys: DataFrame) -> DataFrame:
        return old.join(keys, self.bucket_key, "left_anti")

    def rebucket(self, buckets: int) -> None:
        """Lay the whole table out anew in ``buckets`` buckets (as the table grows)."""
        state = self.manifest.load()
        rows, self.buckets = self.read(), buckets
        version = state["version"] + 1
        parts = ["bucket", *self.partition_by]
        rows.withColumn("bucket", self.bucket_col()).hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(
            f"{self.data}/v={version}"
        )
        written = {n[7:]: version for n in self.manifest.names(f"{self.name}/v={version}") if n.startswith("bucket=")}
        staged = {"key": self.bucket_key, "buckets": buckets, "current": written}
        self.manifest.commit(state, {self.name: staged}, "rebucket", version)
