"""Tables that batches commit to: what a reader sees is what the log of a batch names.

A batch writes its files under names of their own and then one log entry; a batch
that failed half-way has none, and one that runs again replaces its own. On top of
that `MergedRuns` keeps a table by key whose files don't grow in number with the
batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BATCH = "batch_id"
ENTRY = "name string, path string, level int, first_batch bigint, last_batch bigint"
KEEP = 2  # log entries, and the files they name


@dataclass(frozen=True)
class Files:
    """A folder of files that a batch, or a merge of several, has written."""

    name: str
    path: str
    level: int
    first_batch: int
    last_batch: int


class CommitLog:
    """Entries under ``<folder>/log``, one to a batch."""

    def __init__(self, folder: str):
        self.folder = folder

    def _rows(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(f"{ENTRY}, {BATCH} bigint").parquet(f"{self.folder}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], f"{ENTRY}, {BATCH} bigint")

    def state(self, spark: SparkSession, before: int | None = None) -> list[Files]:
        """What the newest entry names, or the newest of a batch before `before`. Its
        rows are few: the log is of files, not of data."""
        rows = self._rows(spark)
        if before is not None:
            rows = rows.where(F.col(BATCH) < before)
        newest = rows.agg(F.max(BATCH).alias("newest"))
        found = rows.where(F.col(BATCH) == newest.scalar()).drop(BATCH).collect()
        return sorted((Files(*r) for r in found), key=lambda f: (f.first_batch, f.name))

    def commit(self, spark: SparkSession, batch_id: int, files: Sequence[Files]) -> None:
        rows = [(f.name, f.path, f.level, f.first_batch, f.last_batch) for f in files]
        entry = spark.createDataFrame(rows, ENTRY).coalesce(1)
        entry.write.mode("overwrite").parquet(f"{self.folder}/log/{BATCH}={batch_id}")

    def prune(self, spark: SparkSession) -> None:
        """Drop entries but the newest, and the files that only the dropped ones name:
        a reader that has just read the log still finds all of its files."""
        rows = [(r[BATCH], r["path"]) for r in self._rows(spark).collect()]
        kept = set(sorted({b for b, _ in rows})[-KEEP:])
        used = {p for b, p in rows if b in kept}
        for path in {p for b, p in rows} - used:
            dropped(spark, path)
        for batch in {b for b, _ in rows} - kept:
            dropped(spark, f"{self.folder}/log/{BATCH}={batch}")

    def new_path(self) -> str:
        return f"{self.base}/run={uuid.uuid4().hex}"

    @property
    def base(self) -> str:
        return f"{self.folder}/data"


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can reach it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_files(
    spark: SparkSession, schema: T.StructType, files: Sequence[Files], base: str | None = None
) -> DataFrame:
    """The rows of some files, which may be none, under `base` if they lie in folders by
    bucket."""
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if base:
        reader = reader.option("basePath", base)
    return reader.parquet(*(f.path for f in files)).select(*schema.names)


class CurrentTable:
    """The table that complete mode describes: each batch holds all of it.

    A batch is written beside the one before and takes its place by its log entry, so
    a reader, or a crash, never meets a table half written.
    """

    def __init__(self, folder: str):
        self.log = CommitLog(folder)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark, path = batch.sparkSession, self.log.new_path()
        batch.write.parquet(path)
        self.log.commit(spark, batch_id, [Files("table", path, 0, batch_id, batch_id)])
        self.log.prune(spark)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return read_files(spark, schema, self.log.state(spark))


class MergedRuns:
    """A table by key out of what the batches bring.

    `reduce` makes a run out of a batch, with at most one row to a key, and
    `merge` one out of several. A run is written in files by bucket of the key. Once
    `fan` runs are on a level they are merged into one on the next, while the next
    batch is under way; so there are at most ``fan - 1`` runs to a level (and those
    being merged), a row is rewritten once a level, and no table is rewritten whole
    for a batch. The rows are at most the keys times the runs.
    """

    def __init__(
        self,
        folder: str,
        keys: Sequence[str],
        reduce: Callable[[DataFrame], DataFrame],
        merge: Callable[[DataFrame], DataFrame],
        fan: int = 4,
        buckets: int = 8,
    ):
        self.log, self.keys = CommitLog(folder), list(keys)
        self.reduce, self.merge, self.fan, self.buckets = reduce, merge, fan, buckets
        self._pool = ThreadPoolExecutor(1)
        self._merging: Future | None = None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch; one that runs again replaces what its first run added."""
        spark = batch.sparkSession
        files = self.log.state(spark, before=batch_id)
        run = self.reduce(batch)
        files.append(self._written(run, 0, batch_id, batch_id))
        files = self._with_merged(files)
        self.log.commit(spark, batch_id, files)
        self.log.prune(spark)
        old = self._due(files)
        if old:
            self._merging = self._pool.submit(self._merged, spark, run.schema, old)

    def _written(self, run: DataFrame, level: int, first: int, last: int) -> Files:
        path = self.log.new_path()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        run.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(path)
        return Files("run", path, level, first, last)

    def _due(self, files: list[Files]) -> list[Files]:
        for level in sorted({f.level for f in files}):
            same = [f for f in files if f.level == level]
            if len(same) >= self.fan:
                return same[: self.fan]
        return []

    def _merged(self, spark: SparkSession, schema: T.StructType, old: list[Files]):
        runs = read_files(spark, schema, old, self.log.base)
        new = self._written(
            self.merge(runs), old[0].level + 1, old[0].first_batch, old[-1].last_batch
        )
        return old, new

    def _with_merged(self, files: list[Files]) -> list[Files]:
        """The files with the last merge in place of what it merged, if they are still
        those; a merge whose process died leaves them as they were."""
        if self._merging is None:
            return files
        old, new = self._merging.result()
        self._merging = None
        if not set(old) <= set(files):
            return files
        rest = [f for f in files if f not in old]
        return sorted([*rest, new], key=lambda f: f.first_batch)

    def runs(self, spark: SparkSession) -> list[Files]:
        return self.log.state(spark)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The merged rows of all runs; `schema` is that of a run."""
        return self.merge(read_files(spark, schema, self.runs(spark), self.log.base))


class Versions:
    """The table that update mode describes: of each key the row of its last batch.

    As `MergedRuns`, so that old versions go.
    """

    def __init__(self, folder: str, keys: Sequence[str], fan: int = 4, buckets: int = 8):
        self.keys = list(keys)
        self.store = MergedRuns(folder, keys, lambda batch: batch, self._latest, fan, buckets)

    def _latest(self, versions: DataFrame) -> DataFrame:
        values = [c for c in versions.columns if c not in self.keys]
        # each column by itself: rows with a struct in their state would have to be sorted
        last = [F.max_by(c, BATCH).alias(c) for c in values]
        newest = F.max(BATCH).alias(BATCH)
        latest = versions.groupBy(*self.keys).agg(*(newest if c == BATCH else l for c, l in zip(values, last)))
        return latest.select(*self.keys, *values)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        self.store.write(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), batch_id)

    def latest(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """One row per key; `schema` is that of the stream."""
        fields = [*schema.fields, T.StructField(BATCH, T.LongType())]
        return self.store.read(spark, T.StructType(fields)).drop(BATCH)
