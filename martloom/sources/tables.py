"""Warehouse tables as Parquet folders, one per layer and name."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse layers.
LAYERS = ("staging", "intermediate", "mart", "dq")


# Holds the raw text of a row that did not fit its schema.
REJECT_COLUMN = "_rejected_row"

BATCH_LOG = (
    "version int, load_batch int, load_attempt int, rows bigint, last_key bigint, replaced_column string, replaced array<int>"
)


@dataclass(frozen=True)
class Batch:
    """A recorded batch: its latest attempt, rows, own keys, and the partitions of earlier batches it replaces."""

    attempt: int
    rows: int | None
    last_key: int
    replaced_column: str | None
    replaced: tuple[int, ...]


class Warehouse:
    """A root folder with ``<layer>/<table>`` below it.

    A table is a list of snapshots. A rewrite (rebuild, update, type-2 merge) writes a new
    snapshot and then adds one row to the ``current`` log, so a failed write is never read and
    no job overwrites the files it is reading. The row holds the snapshot's schema too, so a table
    without rows can be read. A snapshot may consist of numbered batches, to which incremental loads
    add; each is read once its row is in the ``batches`` log. That row also holds the batch's row count, the last of its own
    keys, so that the next batch can number on without reading the table, and the partitions (of an integer partition
    column) that it replaces: readers skip those partitions of all earlier batches.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _folder(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{table}"

    def _files(self, path: str):
        """The file system of a path, and the path as it wants it."""
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _folders(self, path: str) -> list[tuple[str, int]]:
        """Names of the folders in a folder, each with the time (ms) of its last change."""
        files, folder = self._files(path)
        if not files.exists(folder):
            return []
        return [(f.getPath().getName(), f.getModificationTime()) for f in files.listStatus(folder) if f.isDirectory()]

    def compact(self, layer: str, table: str, partition_by: Sequence[str] = ()) -> None:
        """Merge all batches of a table into one, under the number of the last: a new snapshot with few files.

        Rows and own keys stay, rows of replaced partitions are gone for good, and the next batch numbers on."""
        batches = self._batches(layer, table, self.version(layer, table))
        if not batches:
            raise ValueError(f"{layer}.{table} has no batches")
        number = max(batches)
        rows = self.read(layer, table).drop("load_batch")
        self.append(rows, layer, table, number, partition_by, fresh=True, last_key=max(b.last_key for b in batches.values()))

    def tidy(self, layer: str, table: str, grace: timedelta) -> list[str]:
        """Remove what no reader can reach any more and was last changed before the grace period: older snapshots, and
        attempts at batches that failed or were repeated. Returns the removed folders.

        The grace period must be longer than the longest query or load, which may still read or write such folders."""
        folder, version = self._folder(layer, table), self.version(layer, table)
        files, _ = self._files(folder)
        before = time.time() * 1000 - grace / timedelta(milliseconds=1)
        batches = self._batches(layer, table, version)
        gone = [f"{folder}/{name}" for name, at in self._folders(folder) if name.startswith("version=") and int(name[8:]) < version and at <= before]
        for name, _ in self._folders(f"{folder}/version={version}") if batches else ():
            known = batches.get(int(name.removeprefix("load_batch="))) if name.startswith("load_batch=") else None
            for attempt, at in self._folders(f"{folder}/version={version}/{name}"):
                if attempt.startswith("load_attempt=") and known and int(attempt[13:]) < known.attempt and at <= before:
                    gone.append(f"{folder}/version={version}/{name}/{attempt}")
        for path in gone:
            files.delete(self._files(path)[1], True)
        return gone

    def _exists(self, path: str) -> bool:
        files, hadoop_path = self._files(path)
        return files.exists(hadoop_path)

    def version(self, layer: str, table: str) -> int:
        """Number of the current snapshot, 0 when the table does not exist."""
        return self._snapshot(layer, table)[0]

    def _snapshot(self, layer: str, table: str) -> tuple[int, T.StructType | None]:
        """Number and schema of the current snapshot."""
        log = f"{self._folder(layer, table)}/current"
        if not self._exists(log):
            return 0, None
        rows = self.spark.read.schema("version int, columns string").parquet(log).collect()  # a row per rewrite
        version, columns = max(((r["version"], r["columns"]) for r in rows), key=lambda r: r[0], default=(0, None))
        return version, T.StructType.fromDDL(columns) if columns else None

    def _batches(self, layer: str, table: str, version: int) -> dict[int, Batch]:
        """Recorded batches of a snapshot, each with its latest attempt."""
        log = f"{self._folder(layer, table)}/batches"
        if not self._exists(log):
            return {}
        rows = self.spark.read.schema(BATCH_LOG).parquet(log).where(F.col("version") == version).collect()  # a row per load
        return {
            r["load_batch"]: Batch(r["load_attempt"], r["rows"], r["last_key"] or 0, r["replaced_column"], tuple(r["replaced"] or ()))
            for r in sorted(rows, key=lambda r: r["load_attempt"])
        }

    def last_key(self, layer: str, table: str, before_batch: int) -> int:
        """The largest own key that recorded batches below this one have given out; 0 if none."""
        batches = self._batches(layer, table, self.version(layer, table))
        return max((b.last_key for n, b in batches.items() if n < before_batch), default=0)

    def last_batch(self, layer: str, table: str) -> int:
        """Number of the newest recorded batch, 0 if none."""
        return max(self._batches(layer, table, self.version(layer, table)), default=0)

    def exists(self, layer: str, table: str) -> bool:
        return self.version(layer, table) > 0

    def write(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace the table by ``df`` and return it as read back."""
        version = self.version(layer, table) + 1
        self._write_files(df, f"{self._folder(layer, table)}/version={version}", partition_by)
        self._make_current(layer, table, version, df.schema)
        return self.read(layer, table)

    def write_parsed(self, df: DataFrame, layer: str, table: str, accept: Callable[[int], None]) -> int:
        """Replace the table by parsed rows, some of which hold a rejected raw row instead; returns the number of those.

        The rows are written once, rejects among them, and split when read. ``accept`` gets the number of rejects before the new
        snapshot becomes current, and may raise."""
        version = self.version(layer, table) + 1
        rejects = F.count(REJECT_COLUMN)
        found = self._write_files(df, f"{self._folder(layer, table)}/version={version}", (), rejects=rejects)[1]
        accept(found)
        self._make_current(layer, table, version, df.schema)
        return found

    def rejects(self, layer: str, table: str) -> DataFrame:
        """The raw rows that did not fit the table's schema."""
        rows = self._read(layer, table)
        if REJECT_COLUMN not in rows.columns:
            rows = rows.withColumn(REJECT_COLUMN, F.lit(None).cast("string"))
        return rows.where(F.col(REJECT_COLUMN).isNotNull()).select(F.col(REJECT_COLUMN).alias("raw_row"))

    def append(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        batch: int,
        partition_by: Sequence[str] = (),
        fresh: bool = False,
        key: str | None = None,
        last_key: int | None = None,
        replaces: tuple[str, Sequence[int]] | None = None,
    ) -> int:
        """Add one numbered batch and return its number of rows; the table then has the column ``load_batch``.

        Writing the same batch again replaces it, so a load can be repeated after a failure. It is a
        further attempt in a folder of its own: readers see the old rows until it is recorded.
        ``fresh`` starts a new snapshot with this batch as its only one. ``key`` names the table's own key in
        ``df``, whose largest value is recorded (or ``last_key``). ``replaces`` names a partition column and values: the
        batch takes the place of these partitions of all earlier ones.
        """
        current = self.version(layer, table)
        version = current + 1 if fresh else max(current, 1)
        known = self._batches(layer, table, version).get(batch)
        attempt = known.attempt + 1 if known else 1
        rows, largest = self._write_files(df, self._batch_folder(layer, table, version, batch, attempt), partition_by, key)
        column, values = replaces or (None, ())
        if column and column not in partition_by:
            raise ValueError(f"{table} is not partitioned by {column}")
        log = {"rows": rows, "last_key": largest if last_key is None else last_key, "replaced_column": column, "replaced": sorted(values) or None}
        self._record(layer, table, "batches", BATCH_LOG, version=version, load_batch=batch, load_attempt=attempt, **log)
        if version != current:
            self._make_current(layer, table, version, T.StructType([*df.schema, T.StructField("load_batch", T.IntegerType())]))
        return rows

    def _batch_folder(self, layer: str, table: str, version: int, batch: int, attempt: int) -> str:
        return f"{self._folder(layer, table)}/version={version}/load_batch={batch}/load_attempt={attempt}"

    def read(self, layer: str, table: str) -> DataFrame:
        rows = self._read(layer, table)
        return rows.where(F.col(REJECT_COLUMN).isNull()).drop(REJECT_COLUMN) if REJECT_COLUMN in rows.columns else rows

    def _read(self, layer: str, table: str) -> DataFrame:
        version, schema = self._snapshot(layer, table)
        if not version:
            raise LookupError(f"{layer}.{table} has not been written")
        folder = f"{self._folder(layer, table)}/version={version}"
        batches = self._batches(layer, table, version)
        paths = [self._batch_folder(layer, table, version, n, b.attempt) for n, b in sorted(batches.items())] or [folder]
        reader = self.spark.read.option("basePath", folder)
        rows = (reader.schema(schema) if schema else reader).parquet(*paths).drop("load_attempt")
        for number, batch in sorted(batches.items()):
            if batch.replaced:  # both are partition columns, so the files of replaced partitions are never listed for reading
                rows = rows.where((F.col("load_batch") >= number) | ~F.col(batch.replaced_column).isin(*batch.replaced))
        return rows

    def _write_files(
        self, df: DataFrame, path: str, partition_by: Sequence[str], key: str | None = None, rejects: Column | None = None
    ) -> tuple[int, int | None]:
        """Write and return the number of rows and the largest ``key`` (or the number of rejects), observed by the write itself.

        Partitioned tables are rebalanced by the partition columns first: few, evenly sized
        files per partition, and AQE splits a partition that holds much of the data. The counts are taken after
        that shuffle, in the tasks that write, each of which counts once however often it is tried."""
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        seen = Observation()
        other = F.max(key if key else F.lit(None).cast("bigint")) if rejects is None else rejects
        df.observe(seen, F.count(F.lit(1)).alias("rows"), other.alias("other")).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return seen.get["rows"], seen.get["other"]

    def _make_current(self, layer: str, table: str, version: int, schema: T.StructType) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self._record(layer, table, "current", version=version, columns=columns)

    def _record(self, layer: str, table: str, log: str, schema: str = "", **values: object) -> None:
        kinds = dict(c.split(" ", 1) for c in schema.split(", ")) if schema else {}
        columns = [F.lit(v).cast(kinds[c]).alias(c) if c in kinds else F.lit(v).alias(c) for c, v in values.items()]
        self.spark.range(0, 1, 1, 1).select(*columns).write.mode("append").parquet(f"{self._folder(layer, table)}/{log}")
