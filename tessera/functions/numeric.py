"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_fp(x: Column, digits: int) -> Column:
    """Round half away from zero on the binary value (``x·10^d`` then round), as
    Python/NumPy/DuckDB round floats; ``F.round`` rounds the decimal string form
    instead and can differ on values like 0.5065."""
    m = float(10 ** digits)
    v = x.cast("double") * m
    r = F.when(v >= 0, F.floor(v + 0.5)).otherwise(F.ceil(v - 0.5)) / m
    return F.when(x.isNull() | F.isnan(x.cast("double")), x.cast("double")).otherwise(r)


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(df, name: str) -> Column:
    """Microseconds since the epoch of a timestamp column, independent of the
    session time zone (wall-clock for TIMESTAMP_NTZ, instant for TIMESTAMP)."""
    kind = dict(df.dtypes)[name]
    if kind == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)")
    return F.unix_micros(F.col(name))


def ntz_from_micros(us: Column) -> Column:
    """TIMESTAMP_NTZ wall-clock for epoch microseconds (zone independent)."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH_NTZ))
