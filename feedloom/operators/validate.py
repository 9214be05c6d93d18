"""Record checks that split a table into valid rows and rejected rows (V1-V3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.schemas import REQUIRED


def reasons(kind: str, dim: int | None = None) -> Column:
    """All reasons against a row of `kind`, as an array of texts (empty = valid).

    V1: required fields are present.  V2: a vector has exactly `dim` finite parts and is
    not zero, as a zero vector has no cosine distance.  V3: confidence lies in [0, 1].
    """
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED[kind]]
    if kind == "embedding" and dim is not None:
        vector = F.col("vector")
        checks.append(F.when(vector.isNotNull() & (F.size(vector) != dim), F.lit("wrong dimension")))
        finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        checks.append(F.when(vector.isNotNull() & ~F.coalesce(finite, F.lit(False)), F.lit("part not finite")))
        checks.append(F.when(F.forall(vector, lambda x: x == 0), F.lit("zero vector")))
    if kind == "tag":
        checks.append(F.when(~F.col("confidence_score").between(0.0, 1.0), F.lit("confidence out of range")))
    return F.array_compact(F.array(*checks))


def validate(df: DataFrame, kind: str, dim: int | None = None) -> DataFrame:
    """The rows with two more columns: `valid` and the joined `reason`."""
    return df.withColumn("reason", F.array_join(reasons(kind, dim), "; ")).withColumn(
        "valid", F.col("reason") == ""
    )


def split_valid(df: DataFrame, kind: str, dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    checked = validate(df, kind, dim)
    return checked.filter("valid").drop("valid", "reason"), checked.filter("NOT valid").drop("valid")


def require_columns(df: DataFrame, kind: str) -> DataFrame:
    """Fail early, by name, when a required column does not exist at all."""
    absent = [c for c in REQUIRED[kind] if c not in df.columns]
    if absent:
        raise ValueError(f"{kind}: missing columns {absent}")
    return df


