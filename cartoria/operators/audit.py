"""Counts, ranked histograms and reconciliation in single passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def histogram(df: DataFrame, key: Column, name: str, order: str | None = None) -> DataFrame:
    """``name, n`` and, with ``order``, ``first``: where the value was seen first, which breaks ties in rankings."""
    seen = [F.min(order).alias("first")] if order else []
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n"), *seen)


def over_fixed(counts: DataFrame, name: str, values: list[str], columns: list[str]) -> DataFrame:
    """One row for each fixed value in its given place, with 0 where nothing was counted."""
    fixed = counts.sparkSession.createDataFrame([(i, v) for i, v in enumerate(values)], f"ord int, {name} string")
    return fixed.join(counts, name, "left").select("ord", name, *[F.coalesce(c, F.lit(0)).alias(c) for c in columns])


def percentage(part: Column, whole: Column) -> Column:
    """``12.5%``; of nothing it is ``0.0%``."""
    return F.format_string("%.1f%%", part * 100.0 / F.greatest(whole, F.lit(1)))


def histogram_map(counts: DataFrame, name: str, n: str = "n") -> DataFrame:
    """One row with the histogram as a map in code-point order of its keys. For histograms of few values."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(name), F.lit("")), F.col(n))))).alias("histogram"))


def reconciled(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """One row that reconciles two versions by key: ``extraidos`` (rows), ``ids_unicos``, ``presentes_na_v1``, ``adicionados_na_v2``, ``ausentes``. Null keys count only as rows."""
    rows = now.groupBy(key).agg(F.count("*").alias("n"))
    both = rows.join(before.select(key, F.lit(1).alias("old")).filter(F.col(key).isNotNull()).distinct(), key, "full")
    known = F.col(key).isNotNull()
    return both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("extraidos"), F.count_if(known & F.col("n").isNotNull()).alias("ids_unicos"), F.count_if(F.col("old") == 1).alias("presentes_na_v1"),
        F.count_if(known & F.col("n").isNotNull() & F.col("old").isNull()).alias("adicionados_na_v2"), F.count_if(F.col("n").isNull()).alias("ausentes"),
    )
