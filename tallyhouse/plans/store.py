"""Tables as versioned Parquet folders.

Spark cannot overwrite a path it is reading, so every write goes to a new folder
``root/table/version`` and the newest folder whose job finished (it has ``_SUCCESS``) is the
table. A lost executor costs only task retries; a lost job leaves the previous version in place. The schema
is kept beside the files, so a partitioned table without rows, which has no file, reads as empty.

A version need not hold all its files: ``replace_parts`` writes the partitions that change and a
manifest that names them and the older versions' folders of all others.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from tallyhouse.session import dropping_shuffles


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        return jvm_path.getFileSystem(conf), jvm_path

    def delete_on_exit(self) -> None:
        """Remove all tables when the driver ends, for tables that only serve this session."""
        fs, folder = self._fs(self.root)
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)

    def versions(self, table: str) -> list[str]:
        """Finished versions of a table, oldest first."""
        fs, folder = self._fs(f"{self.root}/{table}")
        if not fs.exists(folder):
            return []
        names = sorted(status.getPath().getName() for status in fs.listStatus(folder))
        done = []
        for name in names:
            marker_fs, marker = self._fs(f"{self.root}/{table}/{name}/_SUCCESS")
            if marker_fs.exists(marker):
                done.append(f"{self.root}/{table}/{name}")
        return done

    def path(self, table: str) -> str | None:
        """The newest finished version, if there is one."""
        versions = self.versions(table)
        return versions[-1] if versions else None

    def exists(self, table: str) -> bool:
        return self.path(table) is not None

    def read(self, table: str) -> DataFrame:
        path = self.path(table)
        if path is None:
            raise LookupError(f"no such table: {table}")
        return self._read(table, path)

    def _read(self, table: str, path: str) -> DataFrame:
        schema, parts = self._schema(path), self._manifest(path)
        if parts is None:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(path)
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        # the version's name is a partition column like the others, so partitions are still pruned
        wide = StructType([*schema.fields]).add("v", StringType())
        files = self.spark.read.option("basePath", base).schema(wide).parquet(*(f"{base}/{x}" for x in parts))
        return files.select(*schema.names)

    def _json(self, file: str):
        fs, there = self._fs(file)
        if not fs.exists(there):
            return None
        stream = fs.open(there)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, file: str, content: str) -> None:
        fs, there = self._fs(file)
        stream = fs.create(there, True)
        try:
            stream.write(content.encode())
        finally:
            stream.close()

    def _schema(self, path: str) -> StructType | None:
        found = self._json(f"{path}/_schema.json")
        return None if found is None else StructType.fromJson(found)

    def _keep_schema(self, path: str, schema: StructType) -> None:
        self._put(f"{path}/_schema.json", schema.json())

    def _manifest(self, path: str) -> list[str] | None:
        """The partitions' folders, from the table's on, of a version that names them."""
        return self._json(f"{path}/_manifest.json")

    def _listed(self, path: str, depth: int) -> list[str]:
        """The same, of the partitions that lie in the version's own folder."""
        fs, pattern = self._fs("/".join([path, *["*=*"] * depth]))
        version = path.rsplit("/", 1)[1]
        folders = [x.getPath().toString().rsplit("/", depth)[1:] for x in fs.globStatus(pattern) or []]
        return sorted("/".join([version, *x]) for x in folders)

    def _parts(self, path: str, depth: int) -> list[str]:
        found = self._manifest(path)
        return self._listed(path, depth) if found is None else found

    def read_if_exists(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a new version and return it as read back."""
        path = self._new_path(table)
        with dropping_shuffles(self.spark):
            df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        self._keep_schema(path, df.schema)
        return self.spark.read.schema(df.schema).parquet(path)

    def _new_path(self, table: str) -> str:
        return f"{self.root}/{table}/v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def replace_parts(
        self, table: str, df: DataFrame, partition_by: Sequence[str], replaced: Collection[tuple]
    ) -> DataFrame:
        """A new version in which ``df`` stands for the partitions ``replaced`` (values of ``partition_by``).

        ``df`` has rows of these partitions alone. No file of another partition is read or written.
        """
        gone = {"/".join(f"{c}={_folder(x)}" for c, x in zip(partition_by, values, strict=True)) for values in replaced}
        return self._with_parts(table, df, partition_by, gone, only=gone)

    def add_parts(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
        """A new version with the rows of ``df`` beside all that are there."""
        return self._with_parts(table, df, partition_by, gone=set(), only=None)

    def _with_parts(
        self, table: str, df: DataFrame, partition_by: Sequence[str], gone: set[str], only: set[str] | None
    ) -> DataFrame:
        before = self.path(table)
        if before is None:
            return self.write(table, df, partition_by)
        path, depth = self._new_path(table), len(partition_by)
        # not shown before its manifest is there
        unmarked = df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").option("compression", "zstd")
        with dropping_shuffles(self.spark):
            unmarked.partitionBy(*partition_by).parquet(path)
        kept = [x for x in self._parts(before, depth) if x.split("/", 1)[1] not in gone]
        new = self._listed(path, depth)
        if only is not None and (others := {x.split("/", 1)[1] for x in new} - only):
            raise ValueError(f"rows of other partitions of {table}: {sorted(others)[:3]}")
        self._keep_schema(path, df.schema)
        self._put(f"{path}/_manifest.json", json.dumps([*kept, *new]))
        self._put(f"{path}/_SUCCESS", "")
        return self._read(table, path)

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Add rows to the current version, or start the table."""
        path = self.path(table)
        if path is None:
            return self.write(table, df, partition_by)
        with dropping_shuffles(self.spark):
            df.write.mode("append").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        return self.read(table)

    def pending(self) -> PendingTables:
        """A place for new versions that are shown together, later."""
        return PendingTables(self)

    def drop_old(self, table: str, keep: int = 2) -> None:
        """Delete all but the newest versions; the one before may still be read.

        Of an older version the partitions stay that one of these still names.
        """
        versions = self.versions(table)
        named = {x for path in versions[-keep:] for x in self._manifest(path) or []}
        for path in versions[:-keep]:
            version = path.rsplit("/", 1)[1]
            used = {x for x in named if x.split("/", 1)[0] == version}
            depth = next(iter(used)).count("/") if used else 0
            for part in set(self._listed(path, depth)) - used if used else [version]:
                fs, folder = self._fs(f"{self.root}/{table}/{part}")
                fs.delete(folder, True)


def _folder(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


class PendingTables(TableStore):
    """Versions written beside a store's tables, which become theirs when all are there."""

    def __init__(self, store: TableStore):
        super().__init__(store.spark, f"{store.root}/_pending/{uuid.uuid4().hex}")
        self._store = store

    def __enter__(self) -> PendingTables:
        return self

    def __exit__(self, *_) -> None:
        self.discard()

    def publish(self) -> None:
        """Move every version to its table; each move is one rename."""
        fs, folder = self._fs(self.root)
        for status in fs.listStatus(folder):
            table = status.getPath().getName()
            for path in self.versions(table):
                _, place = self._fs(f"{self._store.root}/{table}")
                fs.mkdirs(place)
                source, target = self._fs(path)[1], self._fs(f"{self._store.root}/{table}/{path.rsplit('/', 1)[1]}")[1]
                if not fs.rename(source, target):
                    raise OSError(f"cannot move {path} to {target}")

    def discard(self) -> None:
        fs, folder = self._fs(self.root)
        fs.delete(folder, True)
