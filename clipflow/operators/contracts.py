"""Contracts of stages: what may change from one relation to the next, as relations of the breaches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def changed_besides(before: DataFrame, after: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Rows, without the allowed columns, that one side has more often than the other; none if only the allowed ones changed."""
    names = [c for c in before.columns if c not in allowed]
    a, b = before.select(names), after.select(names)
    return a.exceptAll(b).withColumn("side", F.lit("before")).union(b.exceptAll(a).withColumn("side", F.lit("after")))


def frozen_broken(before: DataFrame, after: DataFrame, keys: tuple[str, ...], frozen) -> DataFrame:
    """keys of the frozen rows of `before` that aren't in `after` as they were."""
    return before.where(frozen).join(after, before.columns, "left_anti").select(*keys)


def repeated_keys(d: DataFrame, *keys: str) -> DataFrame:
    """keys that stand in more than one row, and in how many."""
    return d.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def forbidden_changes(before: DataFrame, after: DataFrame, key: str, allowed: dict[str, tuple[str, ...]], class_column: str = "class_name") -> DataFrame:
    """(key, class, changed): the columns that changed though the row's class doesn't allow them to; rows of other classes may change nothing.

    Rows that share a key are told apart by the order of their class and values.
    """
    names = [c for c in before.columns if c not in (key, class_column)]
    nth = F.row_number().over(W.partitionBy(key).orderBy(class_column, *names))
    b = before.withColumn("_nth", nth).alias("b").join(after.withColumn("_nth", nth).alias("a"), [key, "_nth"])
    differs = [F.when(~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")), F.lit(c)) for c in names]
    own = F.col(f"b.{class_column}")
    free = reduce(lambda rest, kv: F.when(own == kv[0], F.array(*map(F.lit, kv[1]))).otherwise(rest), allowed.items(), F.array().cast("array<string>"))
    out = b.select(key, own.alias("class_name"), F.array_except(F.array_compact(F.array(*differs)), free).alias("_c")).where(F.size("_c") > 0)
    return out.select(key, "class_name", F.array_join(F.sort_array("_c"), ",").alias("changed"))
