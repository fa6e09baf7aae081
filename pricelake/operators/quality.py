"""Data-quality rules. Every check returns rows of (rule, failures, status)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All row-level rules of a table in one pass; a rule fails on rows where its condition is false, not null."""
    counts = df.agg(*[F.count_if(~ok).alias(name) for name, ok in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("failures")) for n in rules])
    return _status(counts.select(F.inline(rows)))


def not_null(*columns: str) -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNotNull() for c in columns}


def accepted(column: str, values: Sequence[object]) -> dict[str, Column]:
    """Nulls pass; `not_null` is a rule of its own."""
    return {f"accepted:{column}": F.col(column).isNull() | F.col(column).isin(list(values))}


def expression(name: str, condition: Column | str) -> dict[str, Column]:
    return {f"expression:{name}": F.expr(condition) if isinstance(condition, str) else condition}


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return row_rules(df, not_null(*columns))


def dq_accepted(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return row_rules(df, accepted(column, values))


def dq_expression(df: DataFrame, name: str, condition: Column | str) -> DataFrame:
    return row_rules(df, expression(name, condition))


def dq_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. One column: nulls do not count as equal."""
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    repeated = rows.groupBy(*columns).count().filter(F.col("count") > 1)
    rule = F.lit("unique:" + ",".join(columns)).alias("rule")
    return _status(repeated.agg(F.count(F.lit(1)).alias("failures")).select(rule, "failures"))


def dq_relationship(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key is not in the parent. Keys are counted first, so a frequent key is joined once."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).count()
    known = parent.select(F.col(field).alias("_known"))
    orphans = keys.join(known, F.col(column) == F.col("_known"), "left_anti")
    rule = F.lit(f"relationship:{column}").alias("rule")
    return _status(orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failures")).select(rule, "failures"))


def dq_freshness(
    df: DataFrame, column: str, as_of: str, warn_days: int = 1, error_days: int = 2
) -> DataFrame:
    """Age in days of the newest date: pass, warn (older than `warn_days`) or error (older than `error_days`)."""
    age = F.datediff(F.lit(str(as_of)).cast("date"), F.max(column))
    rows = df.agg(age.cast("long").alias("failures")).select(F.lit(f"freshness:{column}").alias("rule"), "failures")
    late = F.col("failures")
    status = F.when(late.isNull() | (late > error_days), "error").when(late > warn_days, "warn").otherwise("pass")
    return rows.withColumn("status", status)


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """All results in one table."""
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def _status(rows: DataFrame) -> DataFrame:
    return rows.select("rule", F.col("failures").cast("long").alias("failures")).withColumn(
        "status", F.when(F.col("failures") > 0, "fail").otherwise("pass")
    )
