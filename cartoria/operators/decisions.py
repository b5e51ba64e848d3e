"""A decision log: keyed upserts, overlay on the queue, validation of imports, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartoria.functions.text import stripped

# What a decision can be.
STATUSES = ["manter", "falso_positivo", "pendente"]


def latest_decisions(log: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One decision for each key, the last in ``order``; equal rows count once. Rows without a key are left out."""
    others = [c for c in log.columns if c != key]
    best = log.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*others).alias("row"))).alias("m"))
    return best.select(key, "m.row.*")


def upserted(stored: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """The store after an upsert: for each key the row of largest ``order``, incoming before stored at equal order."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_decisions(both, key, [F.col(order), F.col("_new")]).drop("_new")


def valid_imports(log: DataFrame, known: DataFrame, key: str, status: str = "status_revisao") -> DataFrame:
    """Rows with a known key and a status that exists; everything else about them is taken as it is."""
    return log.filter(F.col(status).isin(STATUSES)).join(known.select(key).distinct(), key, "left_semi").select(*log.columns)


def imported(stored: DataFrame, log: DataFrame, known: DataFrame, key: str, order: str) -> DataFrame:
    """The store after a bulk upsert of the valid rows of ``log``, which carry ``origem`` 'CSV importado'; null reasons and remarks become ''."""
    rows = valid_imports(log, known, key).withColumns({"motivo_decisao": F.coalesce("motivo_decisao", F.lit("")), "observacoes": F.coalesce("observacoes", F.lit("")), "origem": F.lit("CSV importado")})
    return upserted(stored, rows, key, order)


def writable(decisions: DataFrame, status: str = "status_revisao", reason: str = "motivo_decisao") -> DataFrame:
    """What may be written as a reviewer's decision: a false positive needs a reason, any other status loses its own."""
    stated = F.coalesce(stripped(F.col(reason)) != "", F.lit(False))
    kept = decisions.filter(F.col(status).isin(STATUSES) & ((F.col(status) != "falso_positivo") | stated))
    return kept.withColumn(reason, F.when(F.col(status) == "falso_positivo", stripped(F.col(reason))).otherwise(""))


def overlaid_queue(queue: DataFrame, decisions: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The queue with the decision's ``fields`` where there is a decision; ``decidido`` tells which."""
    made = decisions.select(key, *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_made"))
    joined = queue.join(made, key, "left").withColumn("decidido", F.coalesce("_made", F.lit(False)))
    return joined.withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).select(*queue.columns, "decidido")


def queue_filter(queue: DataFrame, text: str = "", status: str | None = None, suggestion: str | None = None) -> DataFrame:
    """The queue's rows with a text in name, address or neighbourhood and a status and suggestion; '' and None mean all."""
    if text:
        hay = F.lower(F.concat_ws(" ", "nome", "endereco", "bairro"))
        queue = queue.filter(F.contains(hay, F.lit(text.strip().lower())))
    if status is not None:
        queue = queue.filter(F.col("status_revisao") == status)
    if suggestion is not None:
        queue = queue.filter(F.col("sugestao") == suggestion)
    return queue
