"""File trees as a Spark data source (``format("corpus_tree")``), batch and stream.

The driver lists directories only until there are enough of them to deal out;
tasks list the rest and read the files. Globs, suffixes and the filters that
Spark pushes down are judged on the relative path before a file is opened, so a
file that does not count costs a directory entry and no bytes.

Options: ``path`` (any store that pyarrow opens: ``file``, ``hdfs``, ``s3``, ``gs``),
``glob`` (default: everything), ``suffixes`` (comma-separated; default: the supported
ones; empty: any), ``globs`` (JSON: first path component -> glob of the rest, for a
folder of repositories; components that it lacks do not count), ``partitions`` (tasks,
about) and, for streams, ``settle`` (seconds; younger files wait for a later poll).

A stream keeps its own offsets: the modification time and path of the last file
of a poll. It gives every file once per modification time that is later than the
polls before; a file put in place with an older time is not seen.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith

from ..functions.constants import ALL_SUFFIXES, DEFAULT_GLOB

TREE_SCHEMA = "path string, length long, modified timestamp, content binary"
#: Files of a directory that one task reads, and tasks that a tree is dealt to, about.
FILES, TASKS = 2_000, 64


def glob_pattern(glob: str) -> re.Pattern[str]:
    """The pattern of a path glob, by the rules of ``functions.text.glob_regex``."""
    parts = re.split(r"(\*\*/|\*\*|\*|\?|\[[^\]]+\])", glob)  # a class of characters stays one
    shown = {"**/": "(?:[^/]*/)*", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(p if p[:1] == "[" and len(p) > 1 else shown.get(p, re.escape(p)) for p in parts))


class Wanted:
    """Whether a relative path counts: by glob, suffix and pushed filters, without opening the file."""

    def __init__(self, options: dict[str, str]):
        suffixes = options.get("suffixes", ",".join(ALL_SUFFIXES))
        self.suffixes = tuple(s.strip().lower() for s in suffixes.split(",") if s.strip())
        self.glob = glob_pattern(options.get("glob", DEFAULT_GLOB))
        self.globs = {k: glob_pattern(v) for k, v in json.loads(options["globs"]).items()} if options.get("globs") else None
        self.filters: list[Filter] = []

    def push(self, pushed: Filter) -> bool:
        """Take a filter on the path; False if it is none that a path decides."""
        takes = isinstance(pushed, (EqualTo, In, StringStartsWith, StringEndsWith)) and pushed.attribute == ("path",)
        if takes:
            self.filters.append(pushed)
        return takes

    def __call__(self, rel: str) -> bool:
        name = rel.rpartition("/")[2]
        stem, dot, last = name.rpartition(".")
        if self.suffixes and ((dot + last).lower() not in self.suffixes or not stem):
            return False
        if self.globs is None:
            fits = bool(self.glob.fullmatch(rel))
        else:
            first, _, rest = rel.partition("/")
            fits = first in self.globs and bool(self.globs[first].fullmatch(rest))
        return fits and all(self._passes(f, rel) for f in self.filters)

    @staticmethod
    def _passes(f: Filter, rel: str) -> bool:
        if isinstance(f, EqualTo):
            return rel == f.value
        if isinstance(f, In):
            return rel in f.value
        return rel.startswith(f.value) if isinstance(f, StringStartsWith) else rel.endswith(f.value)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


@dataclass
class Folder(InputPartition):
    """A directory that a task lists with all that is below it."""

    path: str


@dataclass
class Files(InputPartition):
    """Files by relative path; those of a stream with the end of their poll."""

    paths: list[str]


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.tasks = int(options.get("partitions", TASKS))
        self.wanted = Wanted(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.wanted.push(f):
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _store(self.root)
        folders, files = [root], []
        while folders and len(folders) < self.tasks:  # one more level, until there are enough directories
            below = []
            for folder in folders:
                for info in store.get_file_info(fs.FileSelector(folder)):
                    if info.type == fs.FileType.Directory:
                        below.append(info.path)
                    elif info.type == fs.FileType.File and self.wanted(rel := _relative(info.path, root)):
                        files.append(rel)
            folders = below
        return [*map(Folder, folders), *(Files(files[k : k + FILES]) for k in range(0, len(files), FILES))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        store, root = _store(self.root)
        if isinstance(partition, Files):
            paths = (f"{root}/{p}" for p in partition.paths)
            infos = (store.get_file_info(p) for p in paths)
        else:
            infos = _below(store, partition.path)
        for info in infos:
            if info.type == fs.FileType.File and self.wanted(rel := _relative(info.path, root)):
                with store.open_input_stream(info.path) as stream:
                    content = stream.read()
                yield rel, info.size, info.mtime, content


def _relative(path: str, root: str) -> str:
    return path[len(root.rstrip("/")) + 1 :]


def _below(store, folder: str) -> Iterator:
    """Entries below a folder, one directory at a time."""
    from pyarrow import fs

    todo = [folder]
    while todo:
        for info in store.get_file_info(fs.FileSelector(todo.pop())):
            if info.type == fs.FileType.Directory:
                todo.append(info.path)
            yield info


class TreeStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.wanted = options["path"], Wanted(options)
        self.settle = float(options.get("settle", 0))
        self._reader = TreeReader(options)

    def _listed(self, after: tuple[int, str]) -> list[tuple[int, str]]:
        """(modification time in ns, relative path) of the files that count, later than an offset."""
        from pyarrow import fs

        store, root = _store(self.root)
        latest = time.time_ns() - int(self.settle * 1e9) if self.settle else None
        found = ((info.mtime_ns, _relative(info.path, root)) for info in _below(store, root) if info.type == fs.FileType.File)
        return sorted(x for x in found if x > after and (latest is None or x[0] <= latest) and self.wanted(x[1]))

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        last = max(self._listed((-1, "")), default=(-1, ""))
        return {"time": last[0], "path": last[1]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        until = (end["time"], end["path"])
        paths = [rel for at, rel in self._listed((start["time"], start["path"])) if (at, rel) <= until]
        return [Files(paths[k : k + FILES]) for k in range(0, len(paths), FILES)]

    def commit(self, end: dict) -> None:
        """Nothing to do: files stay where they are."""

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self._reader.read(partition)


class TreeSource(DataSource):
    """``spark.read.format("corpus_tree").option("glob", "docs/**/*.md").load(root)``"""

    @classmethod
    def name(cls) -> str:
        return "corpus_tree"

    def schema(self) -> str:
        return TREE_SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(dict(self.options))

    def streamReader(self, schema) -> TreeStream:
        return TreeStream(dict(self.options))


def register_tree_source(spark: SparkSession) -> None:
    """Make ``format("corpus_tree")`` known to the session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TreeSource)
