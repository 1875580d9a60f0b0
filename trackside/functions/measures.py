"""Named aggregates that batch jobs, streams and panes share.

A `Measure` knows its aggregate over rows and, where it can be merged, the
partial columns that let a second aggregation finish the work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Measure:
    fn: str
    column: str
    name: str
    scale: int | None = None

    def _input(self) -> Column:
        col = F.col(self.column)
        return col if self.scale is None else col.cast(f"decimal(18,{self.scale})")

    def expr(self) -> Column:
        """The aggregate over plain rows."""
        col = self._input()
        if self.fn == "avg":
            out = F.avg(col) if self.scale is None else _ratio(F.sum(col), F.count(col))
        elif self.fn == "sum":
            out = F.sum(col) if self.scale is None else F.sum(col).cast("double")
        elif self.fn == "mode":
            out = F.mode(F.col(self.column), True)
        else:
            out = getattr(F, self.fn)(F.col(self.column))
        return out.alias(self.name)

    @property
    def mergeable(self) -> bool:
        """Whether `partials` and `merged` exist for it."""
        return self.fn in ("avg", "sum", "min", "max", "count")

    def partials(self) -> list[Column]:
        """Aggregates over a slice of a group, to be finished by `merged`."""
        col = self._input()
        if self.fn in ("avg", "sum"):
            parts = [F.sum(col).alias(f"{self.name}__sum")]
            if self.fn == "avg":
                parts.append(F.count(col).alias(f"{self.name}__n"))
            return parts
        if self.mergeable:
            return [getattr(F, self.fn)(F.col(self.column)).alias(f"{self.name}__part")]
        raise ValueError(f"{self.fn} cannot be merged from slices of a group")

    def combined(self) -> list[Column]:
        """The columns of `partials` for several slices together."""
        if self.fn in ("avg", "sum"):
            names = [f"{self.name}__sum"] + [f"{self.name}__n"] * (self.fn == "avg")
            return [F.sum(n).alias(n) for n in names]
        part = f"{self.name}__part"
        fn = "sum" if self.fn == "count" else self.fn
        return [getattr(F, fn)(part).alias(part)]

    def merged(self) -> Column:
        """The aggregate from the columns of `partials`."""
        if self.fn == "avg":
            out = _ratio(F.sum(f"{self.name}__sum"), F.sum(f"{self.name}__n"))
        elif self.fn == "sum":
            out = F.sum(f"{self.name}__sum")
            out = out if self.scale is None else out.cast("double")
        elif self.fn == "count":
            out = F.sum(f"{self.name}__part")
        else:
            out = getattr(F, self.fn)(f"{self.name}__part")
        return out.alias(self.name)


def _ratio(total: Column, n: Column) -> Column:
    return total.cast("double") / F.nullif(n, F.lit(0))


def avg_of(column: str, name: str | None = None, scale: int | None = None) -> Measure:
    """Mean without NULLs, as double.

    Double addition depends on the order of the rows, so two runs can differ in
    the last digits. With `scale`, values with that many decimals are added as
    decimals and divided once: the same result in every run, batch or stream.
    """
    return Measure("avg", column, name or f"avg_{column.lower()}", scale)


def sum_of(column: str, name: str | None = None, scale: int | None = None) -> Measure:
    """Sum without NULLs; `scale` as in `avg_of`."""
    return Measure("sum", column, name or f"sum_{column.lower()}", scale)


def max_of(column: str, name: str | None = None) -> Measure:
    return Measure("max", column, name or f"max_{column.lower()}")


def min_of(column: str, name: str | None = None) -> Measure:
    return Measure("min", column, name or f"min_{column.lower()}")


def count_of(column: str, name: str | None = None) -> Measure:
    """Number of non-NULL values."""
    return Measure("count", column, name or f"count_{column.lower()}")


def mode_of(column: str, name: str | None = None) -> Measure:
    """Most frequent value, the smallest of several.

    In a stream it keeps one counter per distinct value and group, so there it is
    for columns with few values (gears, categories).
    """
    return Measure("mode", column, name or f"mode_{column.lower()}")
