"""Joins and sets by key with an explicit order: which of several rows counts is never left to chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cartoria.functions.lineage import cut


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key, the last in ``order``; aggregated before the shuffle, so many copies of a key cost little."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_b"))
    return best.select(*keys, "_b.*")


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key, the first in ``order``."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order)).alias("_b"))
    return best.select(*keys, "_b.*")


def overlaid(df: DataFrame, previous: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """``df`` with ``fields`` replaced by those of the last previous row of its key, where they aren't null."""
    latest = last_wins(previous.select(*keys, order, *fields), keys, order).select(*keys, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = df.join(latest, keys, "left")
    return joined.withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).drop(*[f"_{f}" for f in fields]).select(*df.columns)


def excluded(df: DataFrame, ledger: DataFrame | None, key: list[Column], ledger_key: list[Column]) -> DataFrame:
    """Rows of ``df`` whose key isn't in the ledger. Rows with a null in their key stay; no ledger excludes nothing."""
    if ledger is None:
        return df
    names = [f"_k{i}" for i in range(len(key))]
    keys = ledger.select(*[c.alias(n) for c, n in zip(ledger_key, names)]).distinct()
    return df.withColumns(dict(zip(names, key))).join(keys, names, "left_anti").drop(*names)


def ranked_first(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in order, with their ``rank``; groups of any size are cut before the shuffle."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= n)


def split_by(df: DataFrame, flag: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where ``flag`` is true and all the others, null included."""
    sure = F.coalesce(flag, F.lit(False))
    return df.filter(sure), df.filter(~sure)


def globally_ranked(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """``df`` with its place, from 1, in an order of all rows, which must be total.

    Rows are spread by ranges of the order and numbered within each; what stands in the ranges before is added. No task sees more than its range.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # one row for each range
    before = counts.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"))
    placed = ranged.withColumn("_place", F.row_number().over(W.partitionBy("_range").orderBy(*order)))
    return placed.join(F.broadcast(before), "_range").withColumn(rank, F.col("_place") + F.col("_before")).drop("_range", "_place", "_before")
