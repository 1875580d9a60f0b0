"""Split nested lap messages into the tables lap, weather and car."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trackside import schemas
from trackside.operators.nesting import explode_records, unpack_parents
from trackside.sources import jdbc
from trackside.sources.tables import written
from trackside.streaming.commits import CommitLog, Files, read_files

TABLES = {"lap": schemas.LAP, "weather": schemas.WEATHER, "car": schemas.CAR}
POSITION = "position"
ID_KINDS = {"partition": "int", "offset": "bigint"}

Append = Callable[[DataFrame, str, int, Sequence[str]], None]


def split_nested(nested: DataFrame, id_columns: Sequence[str]) -> dict[str, DataFrame]:
    """The three tables of a frame of nested records.

    Each row carries the message id it came from, and a car row its position in
    the message, so that every stored row has a name.
    """
    return {
        "lap": unpack_parents(nested, "lap", id_columns),
        "weather": unpack_parents(nested, "weather", id_columns),
        "car": explode_records(nested, "car", id_columns, POSITION),
    }


def store_split(
    append: Append, id_columns: Sequence[str] = ("partition", "offset")
) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that stores nested records through `append`.

    The batch is parsed once, into a table in the shared folder that the three
    writes read; the source's options say how much a batch holds
    (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). Three tables are not one
    transaction: if a write fails the batch fails, and running it again leaves
    every row stored once.
    """

    def write(nested: DataFrame, batch_id: int) -> None:
        parsed = written(nested, "store-batch")
        for table, rows in split_nested(parsed, id_columns).items():
            ids = [*id_columns, POSITION] if table == "car" else list(id_columns)
            append(rows, table, batch_id, ids)

    return write


def parquet_tables(folder: str) -> Append:
    """Store as Parquet tables ``<folder>/<table>``, one partition per batch.

    A batch run again replaces its partition.
    """

    def append(rows: DataFrame, table: str, batch_id: int, ids: Sequence[str]) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/{table}/batch_id={batch_id}")

    return append


class CommittedTables:
    """The three tables in Parquet, each batch visible in all of them or in none.

    The files of a batch are written under names of their own; the log entry that
    names them is written when all three are there. A batch that fails before that
    leaves nothing to see, and one that runs again takes the place of its first run.
    """

    def __init__(self, folder: str, id_columns: Sequence[str] = ("partition", "offset")):
        self.log, self.ids = CommitLog(folder), list(id_columns)

    def write(self, nested: DataFrame, batch_id: int) -> None:
        """Store a micro-batch of nested records."""
        spark = nested.sparkSession
        parsed = written(nested, "store-batch")
        new = []
        for table, rows in split_nested(parsed, self.ids).items():
            path = f"{self.log.folder}/{table}/{uuid.uuid4().hex}"
            self.append(rows, path)
            new.append(Files(table, path, 0, batch_id, batch_id))
        # what later batches of an earlier, lost run have added is not kept
        before = [f for f in self.log.state(spark, before=batch_id)]
        self.log.commit(spark, batch_id, [*before, *new])
        self.log.prune(spark)

    def append(self, rows: DataFrame, path: str) -> None:
        rows.write.parquet(path)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """A table as of the last committed batch, with the message ids of its rows."""
        kinds = {"car": "position int"}.get(table, "")
        ids = ", ".join(f"{c} {ID_KINDS[c]}" for c in self.ids)
        ddl = ", ".join(x for x in (ids, kinds, TABLES[table]) if x)
        files = [f for f in self.log.state(spark) if f.name == table]
        return read_files(spark, T.StructType.fromDDL(ddl), files)


def jdbc_tables(db: jdbc.Database) -> Append:
    """Store in JDBC tables, made on first use.

    A batch run again appends only the rows its first run did not store, found
    by message id among the rows with its batch number.
    """

    def append(rows: DataFrame, table: str, batch_id: int, ids: Sequence[str]) -> None:
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        spark = rows.sparkSession
        texts = {n: "VARCHAR(255)" for n, t in schemas.fields(TABLES[table]) if t == "string"}
        # an empty append makes the table if there is none
        _write(rows.limit(0), db, table, texts)
        stored = jdbc.jdbc_scan(spark, db, table).where(F.col("batch_id") == batch_id)
        _write(rows.join(stored.select(*ids), list(ids), "left_anti"), db, table, texts)

    return append


def _write(rows: DataFrame, db: jdbc.Database, table: str, texts: dict[str, str]) -> None:
    options = jdbc.write_options(db, table, texts)
    rows.write.format("jdbc").options(**options).mode("append").save()
