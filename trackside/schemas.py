"""Record types of the topics and session tables, and the contract check.

Schemas are DDL texts, which every Spark reader, ``from_json`` and
``createDataFrame`` take as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Field names and types of the published records.
CAR = (
    "Timestamp timestamp, LapNumber int, Speed float, Throttle float, "
    "Brake int, Gear int, RPM int, DRS int"
)
LAP = (
    "Timestamp timestamp, LapNumber int, Driver string, LapTime float, Stint int, "
    "Sector1Time float, Sector2Time float, Sector3Time float, "
    "Compound string, TyreLife int, Position int"
)
WEATHER = (
    "Timestamp timestamp, LapNumber int, AirTemp float, Humidity float, "
    "Pressure float, Rainfall int, TrackTemp float, WindSpeed float, "
    "WindDirection float, Race string"
)

# Session tables, the input of the producer side.
SESSION_TABLES = {
    "laps": (
        "session string, Driver string, LapNumber int, lap_start timestamp, "
        "lap_end timestamp, LapTime interval day to second, "
        "Sector1Time interval day to second, Sector2Time interval day to second, "
        "Sector3Time interval day to second, Stint int, Compound string, "
        "TyreLife int, Position int"
    ),
    "car_telemetry": (
        "session string, Driver string, ts timestamp, Speed double, Throttle double, "
        "Brake boolean, nGear int, RPM int, DRS int"
    ),
    "weather_samples": (
        "session string, ts timestamp, AirTemp double, Humidity double, "
        "Pressure double, Rainfall boolean, TrackTemp double, WindSpeed double, "
        "WindDirection double"
    ),
}


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat DDL schema."""
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(",")]


def names(ddl: str) -> list[str]:
    """Column names of a flat DDL schema."""
    return [name for name, _ in fields(ddl)]


def struct_type(ddl: str) -> str:
    """The DDL ``struct<...>`` type with the fields of a flat schema."""
    return "struct<" + ", ".join(f"{n}: {t}" for n, t in fields(ddl)) + ">"


# One message per lap: the lap, its weather and all its car points. `part`
# numbers the messages of a lap whose points do not fit into one (nest_records).
NESTED = (
    f"part bigint, lap {struct_type(LAP)}, weather {struct_type(WEATHER)}, "
    f"car array<{struct_type(CAR)}>"
)


class SchemaMismatch(ValueError):
    """A table lacks a declared column or holds it with another type."""


def check_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Return the declared columns of `df` in order, or raise SchemaMismatch.

    For tables whose schema comes from elsewhere (JDBC metadata, Parquet
    footers); only names and types are looked at, no data is read.
    """
    have = dict(df.dtypes)
    wrong = [
        f"{name}: declared {kind}, found {have.get(name, 'nothing')}"
        for name, kind in fields(ddl)
        if have.get(name) != kind
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df.select(*names(ddl))
