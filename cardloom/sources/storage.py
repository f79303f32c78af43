"""Tables in the folder that driver and executors share, and stores of tables that
change by whole commits."""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is made, but only for a
    local master, whose executors live in the driver.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the lineage ends here, so
    a lost executor costs a read and not the work before it."""
    path = f"{shared_folder(df.sparkSession)}/cardloom-{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, unless their Python path has it already."""
    package, context = Path(__file__).resolve().parents[1], spark.sparkContext
    name = f"{package.name}.zip"
    if str(package.parent) in [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(":") if p] or any(f.endswith(name) for f in context._python_includes):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), name)
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)


class Conflict(Exception):
    """Another run has committed since this one began."""


class Store:
    """Tables in a folder, each commit of which is a numbered manifest.

    A manifest names, for each table, its schema and the folders of its data; it is one small
    file, made only if its number is free, so a commit changes all tables of a run at once
    and of two runs that began from the same manifest one fails.  Until then a run writes
    folders that no manifest names: a run that is killed leaves the tables as they were.

    * A *current* table with a key is held in buckets by hash of the key.  ``rewrite``
      reads and writes only the buckets in which its keys lie.
    * A *whole* table is replaced at once.
    * A *history* is a folder for each append, under an id: an append under an id that is
      there already takes its place, so a run that is repeated adds nothing twice.

    ``clean`` removes old manifests and what no manifest names.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 32):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._open: dict | None = None

    # commits

    def _names(self, folder: str) -> list[tuple[str, int]]:
        """Names in a folder of the store, with their times in seconds."""
        path = self._path(f"{self.folder}/{folder}")
        if not self._files.exists(path):
            return []
        return [(f.getPath().getName(), f.getModificationTime() // 1000) for f in self._files.listStatus(path)]

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n, _ in self._names("manifests") if n.removesuffix(".json").isdigit())

    def _read(self, number: int) -> dict | None:
        stream = self._files.open(self._path(f"{self.folder}/manifests/{number}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None  # its writer was killed
        finally:
            stream.close()

    def _manifest(self) -> dict:
        """What this run sees: the newest manifest, with its own changes."""
        if self._open is not None:
            return self._open
        numbers = self._numbers()
        found = next((m for m in map(self._read, reversed(numbers)) if m is not None), {"tables": {}})
        return {"tables": dict(found["tables"]), "number": max(numbers, default=0) + 1}

    def _commit(self, manifest: dict) -> None:
        path = self._path(f"{self.folder}/manifests/{manifest['number']}.json")
        try:
            stream = self._files.create(path, False)
        except Exception as error:  # Java's exception for a file that is there
            raise Conflict(f"manifest {manifest['number']} is there already") from error
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()

    def _put(self, name: str, entry: dict) -> None:
        manifest = self._manifest()
        manifest["tables"][name] = entry
        if self._open is None:
            self._commit(manifest)

    @contextmanager
    def run(self) -> Iterator[None]:
        """Changes within are seen by this run at once, and by others after its end, all
        together; an error leaves all tables as they were."""
        if self._open is not None:  # part of a larger run
            yield
            return
        self._open = self._manifest()
        try:
            yield
            self._commit(self._open)
        finally:
            self._open = None

    # reading

    def names(self) -> list[str]:
        return sorted(self._manifest()["tables"])

    def _frame(self, entry: dict, buckets: Sequence[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        if "appends" in entry:
            paths = [f"{self.folder}/{p}" for p in entry["appends"].values() if p]
            read = self.spark.read.schema(StructType([*schema, *StructType().add("append__", StringType())])).option("basePath", f"{self.folder}/{entry['folder']}")
        else:
            paths = [f"{self.folder}/{p}/bucket__={b}" if b else f"{self.folder}/{p}" for b, p in entry["at"].items() if buckets is None or b in buckets]
            read = self.spark.read.schema(schema)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return read.parquet(*paths).select(*[f"`{c}`" for c in schema.names])

    def current(self, name: str) -> DataFrame | None:
        entry = self._manifest()["tables"].get(name)
        return None if entry is None else self._frame(entry)

    # changes

    def _bucket(self, key: Sequence[str], n: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in key]), F.lit(n)).cast("int")

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Replaces a whole table, which ``df`` may read."""
        folder = f"{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{folder}")
        self._put(name, {"schema": df.schema.jsonValue(), "at": {"": folder}})
        return self.current(name)

    def rewrite(self, name: str, key: Sequence[str], changed: DataFrame, change: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
        """Replaces the buckets that hold keys of ``changed`` by ``change`` of their rows
        (None at first), which may give rows of these keys only beside what it was given."""
        entry = self._manifest()["tables"].get(name)
        n = entry["buckets"] if entry else self.buckets
        touched = {str(r[0]) for r in changed.select(self._bucket(key, n)).distinct().collect()}  # at most `buckets`
        new = change(self._frame(entry, touched) if entry else None)
        folder = f"{name}/{uuid.uuid4().hex}"
        if touched:
            new.withColumn("bucket__", self._bucket(key, n)).hint("rebalance", "bucket__").write.partitionBy("bucket__").parquet(f"{self.folder}/{folder}")
        there = {x.removeprefix("bucket__=") for x, _ in self._names(folder) if x.startswith("bucket__=")}
        kept = {b: p for b, p in entry["at"].items() if b not in touched} if entry else {}
        self._put(name, {"schema": new.schema.jsonValue(), "key": list(key), "buckets": n, "at": kept | dict.fromkeys(sorted(there), folder)})
        return self.current(name)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Replaces all rows of a current table, which ``df`` may read, and keeps its buckets."""
        entry = self._manifest()["tables"][name]
        if "key" not in entry:
            return self.keep(name, df)
        folder = f"{name}/{uuid.uuid4().hex}"
        df.withColumn("bucket__", self._bucket(entry["key"], entry["buckets"])).hint("rebalance", "bucket__").write.partitionBy("bucket__").parquet(f"{self.folder}/{folder}")
        there = [x.removeprefix("bucket__=") for x, _ in self._names(folder) if x.startswith("bucket__=")]
        self._put(name, entry | {"at": dict.fromkeys(sorted(there), folder)})
        return self.current(name)

    def replace_history(self, name: str, df: DataFrame, by: str) -> DataFrame:
        """Replaces all rows of a history, which ``df`` may read; ids of appends stay known."""
        entry = self._manifest()["tables"][name]
        folder = f"{name}/append__={uuid.uuid4().hex}"
        df.write.partitionBy(by).parquet(f"{self.folder}/{folder}")
        empty = not any(x.startswith(f"{by}=") for x, _ in self._names(folder))
        self._put(name, entry | {"appends": dict.fromkeys(entry["appends"]) | {f"all {uuid.uuid4().hex}": None if empty else folder}})
        return self.current(name)

    def rows_of(self, name: str, changed: DataFrame) -> DataFrame | None:
        """The rows in the buckets that hold keys of ``changed``."""
        entry = self._manifest()["tables"].get(name)
        if entry is None:
            return None
        touched = {str(r[0]) for r in changed.select(self._bucket(entry["key"], entry["buckets"])).distinct().collect()}
        return self._frame(entry, touched)

    def append(self, name: str, df: DataFrame, append_id: str, by: str) -> DataFrame:
        """Adds rows to a history, or replaces those that an earlier append under this id has
        added; its folders are divided by ``by``.  ``df`` may read the history."""
        entry = self._manifest()["tables"].get(name)
        folder = f"{name}/append__={uuid.uuid4().hex}"
        df.write.partitionBy(by).parquet(f"{self.folder}/{folder}")
        empty = not any(x.startswith(f"{by}=") for x, _ in self._names(folder))
        schema = entry["schema"] if entry else df.schema.jsonValue()
        appends = (entry["appends"] if entry else {}) | {append_id: None if empty else folder}
        self._put(name, {"schema": schema, "folder": name, "appends": appends})
        return self.current(name)

    def without_append(self, name: str, append_id: str) -> DataFrame | None:
        """A history without the rows of one append, which is about to be replaced."""
        entry = self._manifest()["tables"].get(name)
        return entry and self._frame(entry | {"appends": {k: v for k, v in entry["appends"].items() if k != append_id}})

    def files(self, name: str) -> list[str]:
        """The folders that hold a table, one for each bucket or append."""
        entry = self._manifest()["tables"][name]
        return sorted(f"{p}/{b}" for b, p in entry["at"].items()) if "at" in entry else sorted(filter(None, entry["appends"].values()))

    def clean(self, keep: int = 2, older_than_s: int = 86_400) -> int:
        """Removes all manifests but the newest ``keep``, and folders that none of these
        names and that are older than any run takes; returns the number of folders."""
        numbers, removed, now = self._numbers(), 0, time.time()
        for number in numbers[:-keep]:
            self._files.delete(self._path(f"{self.folder}/manifests/{number}.json"), False)
        tables = [t for n in numbers[-keep:] if (m := self._read(n)) for t in m["tables"].items()]
        named = {p for _, t in tables for p in (t.get("at") or t.get("appends") or {}).values() if p}
        for name, _ in self._names("."):
            for folder, at in self._names(name) if name != "manifests" else ():
                if f"{name}/{folder}" not in named and now - at >= older_than_s:
                    self._files.delete(self._path(f"{self.folder}/{name}/{folder}"), True)
                    removed += 1
        return removed


class Snapshots:
    """One table that is replaced as a whole; a store of its own."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 8):
        self.store = Store(spark, folder, buckets)

    def current(self) -> DataFrame | None:
        return self.store.current("rows")

    def replace(self, df: DataFrame) -> DataFrame:
        """Commits the next snapshot; ``df`` may read the current one."""
        return self.store.keep("rows", df)
