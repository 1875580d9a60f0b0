"""Session tables in files, and the shared folder for written tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackside import schemas


def load_session(
    spark: SparkSession,
    folder: str,
    session: str | None = None,
    fmt: str = "parquet",
    tables: dict[str, str] | None = None,
    key: str = "session",
) -> dict[str, DataFrame]:
    """The tables of a session: laps, car telemetry and weather samples.

    Reads ``<folder>/<table>.<fmt>`` (file or folder) for each table of `tables`
    (name to DDL), checks the declared columns and keeps the rows of `session`,
    or all. CSV is read with the declared schema and a header; Parquet brings
    its own, to be checked.
    """
    out = {}
    for name, ddl in (tables or schemas.SESSION_TABLES).items():
        path = f"{folder}/{name}.{fmt}"
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.schema(ddl).option("header", True)
        df = schemas.check_schema(reader.load(path), ddl)
        out[name] = df if session is None else df.where(F.col(key) == F.lit(session))
    return out


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path for a written table or a stream checkpoint.

    Lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Without one a local session gets a temporary folder; a cluster, where
    executors could not see it, gets an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        shared = os.path.join(tempfile.gettempdir(), "trackside")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    For a frame that several steps use: it is computed once, and a lost executor
    costs a read instead of the way there.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
