"""Problem 9: filling containers of fixed capacity with documents measured in tokens.

Vector best-fit: a container has residual tokens, residual document places and residual attention cost
(the sum of squared lengths). An item goes into a container that has room in every respect; among these a
weighted dot-product of item and residual, or the weighted norm of what would be left, decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartoria.functions.lineage import cut
from cartoria.llm.tokens import TOKENIZERS, encode
from cartoria.sources.tables import table

CAPACITY = 2_048
MAX_DOCUMENTS = 512
#: Attention cost that several documents in one container may have together, as a share of the cost of one that fills it.
COST_SHARE = 0.9


def vector_best_fit(items: np.ndarray, capacity: np.ndarray, weights: np.ndarray, score: str = "norm") -> np.ndarray:
    """The bin of each item; ``items`` is (n, d). An item that alone exceeds a capacity has a bin of its own.

    Items are taken by falling first component, ties in their given order. ``score`` "norm" takes the bin
    whose weighted residual after placing is smallest, "dot" the one with the largest weighted product of item and residual.
    """
    n, d = items.shape
    order = np.argsort(-items[:, 0], kind="stable")
    scaled, w = items / capacity, weights
    left = np.empty((max(16, n), d))
    name = np.empty(max(16, n), dtype=np.int64)
    used = made = 0
    placed = np.empty(n, dtype=np.int64)
    for k in order:
        item = scaled[k]
        if (item > 1 + 1e-12).any():
            placed[k], made = made, made + 1
            continue
        best = -1
        if used:
            room = left[:used]
            fits = np.flatnonzero((room >= item - 1e-12).all(axis=1))
            if fits.size:
                if score == "dot":
                    best = fits[np.argmax((room[fits] * item) @ w)]
                else:
                    best = fits[np.argmin(((room[fits] - item) ** 2) @ w)]
        if best < 0:
            best, left[used], name[used] = used, 1.0, made
            used, made = used + 1, made + 1
        left[best] -= item
        placed[k] = name[best]
        if (left[best] <= 1e-12).any():  # full in one respect: it leaves the open bins
            used -= 1
            left[best], name[best] = left[used], name[used]
    return placed


def pieces(counts: DataFrame, id: str, size: str, capacity: int) -> DataFrame:
    """``id, piece, start, n``: an item as it is, or, if it exceeds the capacity, cut into full pieces and a rest."""
    last = F.greatest(F.ceil(F.col(size) / capacity).cast("int") - 1, F.lit(0))
    cutting = counts.select(F.col(id), F.col(size).alias("_n"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    return cutting.select(id, "piece", start.alias("start"), F.least(F.col("_n") - start, F.lit(capacity)).alias("n"))


def pack(
    counts: DataFrame, id: str, size: str, capacity: int = CAPACITY, max_items: int = MAX_DOCUMENTS, max_cost: float | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-4), score: str = "norm", group_tokens: int = 2_000_000, group_items: int = 50_000,
) -> DataFrame:
    """``container, id, piece, start, n``: every item once; no container over a capacity.

    ``size`` null counts as 0; an item of size 0 takes a place but no tokens. Items are spread evenly by hash over
    as many groups as keep each near ``group_tokens`` and ``group_items``, and each group is packed by one task, so what remains
    unused is at most about one container of ``group_tokens / capacity`` more than packing all at once.
    ``max_cost`` bounds the sum of squared sizes of the items that share a container, by default ``COST_SHARE`` of ``capacity`` squared. A piece that
    alone costs more is never cut for that: it has a container to itself, of which at most ``1 - sqrt(COST_SHARE)`` stays unused.
    """
    max_cost = float(capacity * capacity * COST_SHARE if max_cost is None else max_cost)
    sized = counts.select(id, F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_size"))
    items = pieces(sized, id, "_size", capacity)
    total = items.agg(F.sum("n").alias("tokens"), F.count("*").alias("items")).first()
    groups = max(1, round((total["tokens"] or 0) / group_tokens), round(total["items"] / group_items))
    kind = counts.schema[id].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([id, "piece"], kind="stable")
        n = group["n"].to_numpy(dtype=float)
        vectors = np.column_stack([n, np.ones_like(n), n * n])
        bins = vector_best_fit(vectors, np.array([capacity, max_items, max_cost], dtype=float), np.array(weights), score)
        return group.assign(container=group["_group"].astype("int64") * (1 << 32) + bins)[["container", id, "piece", "start", "n"]]

    spread = items.withColumn("_group", F.pmod(F.xxhash64(id, "piece"), F.lit(groups)).cast("int"))
    return spread.groupBy("_group").applyInPandas(run, f"container bigint, `{id}` {kind}, piece int, start bigint, n bigint")


def p9_containers(spark: SparkSession, directory: str) -> DataFrame:
    """The documents, measured in tokens, in containers of 2,048: one row for each document, or for each piece of a cut one."""
    counts = cut(encode(table(spark, directory, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken", counts_only=True))
    return pack(counts, "doc_id", "n_tokens").select("container", "doc_id", "piece", "start", F.col("n").alias("n_tokens"))


def p9_fill(spark: SparkSession, directory: str) -> DataFrame:
    """How full the containers are: their number, their tokens, the share of the capacity that is used."""
    filled = p9_containers(spark, directory).groupBy("container").agg(F.sum("n_tokens").alias("n"))
    return filled.agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"), F.round(F.sum("n") / (F.count("*") * CAPACITY), 6).alias("fill"))


QUERIES = {"p9_containers": p9_containers, "p9_fill": p9_fill}
SQL: dict[str, str] = {}
