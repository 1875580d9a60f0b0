"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from trackside import schemas

# Without a cursor the MySQL driver keeps a whole result in memory, and without
# rewriting it sends one statement per row.
MYSQL_URL_OPTIONS = {
    "useSSL": "true",
    "useCursorFetch": "true",
    "rewriteBatchedStatements": "true",
}


@dataclass(frozen=True)
class Database:
    """Where a database is and how to sign in; credentials come from the caller."""

    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    fetch_size: int = 10_000
    batch_size: int = 10_000
    connections: int = 16

    @staticmethod
    def mysql(
        host: str,
        name: str,
        user: str,
        password: str,
        port: int = 3306,
        driver: str = "com.mysql.cj.jdbc.Driver",
        **url_options: str,
    ) -> Database:
        settings = {**MYSQL_URL_OPTIONS, **url_options}
        query = "&".join(f"{k}={v}" for k, v in settings.items())
        url = f"jdbc:mysql://{host}:{port}/{name}?{query}"
        return Database(url, driver, user, password)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }


def scan_options(
    db: Database,
    table: str,
    columns: Sequence[str] = (),
    slices: int = 1,
    slice_by: str | None = None,
    bounds: tuple[object, object] | None = None,
) -> dict[str, str]:
    """Reader options of `jdbc_scan`.

    With `bounds`, the table is read by `slices` parallel queries, one per range
    of the column `slice_by` (a number, date or timestamp) from the lower bound to
    the upper; values beyond are in the first and last range, so nothing is left
    out. With an index on the column each query reads its own rows only.

    Without bounds `slice_by` is an integer SQL expression of the database, with a
    query per remainder. That spreads rows evenly where ranges may not, but no
    index serves it: each query scans the whole table.
    """
    listed = ", ".join(columns) or f"{table}.*"
    options = {**db.options(), "fetchsize": str(db.fetch_size)}
    if slice_by is None:
        options["dbtable"] = f"(SELECT {listed} FROM {table}) {table}"
        return options
    if bounds is not None:
        options["dbtable"] = f"(SELECT {listed} FROM {table}) {table}"
        options.update(
            partitionColumn=slice_by,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(slices),
        )
        return options
    options["dbtable"] = (
        f"(SELECT {listed}, MOD({slice_by}, {slices}) AS scan_slice FROM {table}) {table}"
    )
    options.update(
        partitionColumn="scan_slice",
        lowerBound="0",
        upperBound=str(slices),
        numPartitions=str(slices),
    )
    return options


def jdbc_scan(
    spark: SparkSession,
    db: Database,
    table: str,
    schema: str | None = None,
    slices: int = 1,
    slice_by: str | None = None,
    bounds: tuple[object, object] | None = None,
) -> DataFrame:
    """Read a table. With `schema` (DDL) the columns found are checked against it.
    `slices`, `slice_by` and `bounds` as in `scan_options`.

    Filters and the choice of columns made on the result reach the database.
    """
    columns = schemas.names(schema) if schema else ()
    options = scan_options(db, table, columns, slices, slice_by, bounds)
    df = spark.read.format("jdbc").options(**options).load()
    return check(df, schema)


def check(df: DataFrame, schema: str | None) -> DataFrame:
    """`df` without the slicing column, its schema checked if one is given."""
    return schemas.check_schema(df, schema) if schema else df.drop("scan_slice")


def write_options(
    db: Database, table: str, column_types: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Writer options to append to `table`, made with `column_types` if absent."""
    options = {
        **db.options(),
        "dbtable": table,
        "batchsize": str(db.batch_size),
        "numPartitions": str(db.connections),
    }
    if column_types:
        options["createTableColumnTypes"] = ", ".join(
            f"{name} {kind}" for name, kind in column_types.items()
        )
    return options
