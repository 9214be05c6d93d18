"""Plain output forms, so that both engines print the same values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts(name: str, alias: str | None = None) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(alias or name)


def r6(name: str, alias: str | None = None) -> Column:
    return (F.round(F.col(name), 6) + 0.0).alias(alias or name)


def joined(name: str, alias: str | None = None, sep: str = "|") -> Column:
    return F.array_join(F.col(name), sep).alias(alias or name)


def micro(name: str, alias: str | None = None) -> Column:
    """A vector as comma-joined integers in units of 1e-6."""
    scaled = F.transform(F.col(name), lambda x: F.round(x.cast("double") * 1e6).cast("bigint").cast("string"))
    return F.array_join(scaled, ",").alias(alias or name)


# the DuckDB side
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_ts(expr: str) -> str:
    return TS.format(expr)


def sql_micro(expr: str) -> str:
    return (f"array_to_string(list_transform({expr}, lambda x: "
            "CAST(CAST(round(CAST(x AS DOUBLE) * 1e6) AS BIGINT) AS VARCHAR)), ',')")
