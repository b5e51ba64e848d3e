"""Classification of short texts by literal labels and ordered rules, each result with its reason."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from cartoria.functions.text import collapsed, contains_any, first_contained, first_label, folded, stripped

# Declarations that count as missing, and the labels that the result carries.
MISSING = ["não informado", "nao informado", "não informada", "nao informada", "sem informação", "sem informacao"]
UNDECLARED, ABSENT, LITERAL = "Não informado", "ausente-v2.1", "declarado-literal-v2.1"


def with_nation(df: DataFrame, column: str = "nacao") -> DataFrame:
    """Adds the declared label as it is: nothing is split, merged or inferred.

    ``nacao_original`` is stripped (null if empty), ``nacao_categoria`` has single spaces, ``nacao_componentes`` is
    empty and ``nacao_primaria`` null. Null, blank and the fixed remarks are missing.
    """
    original, display = stripped(F.col(column).cast("string")), collapsed(F.col(column).cast("string"))
    missing = F.coalesce((display == "") | folded(display).isin(MISSING), F.lit(True))
    return df.withColumns(
        {
            "nacao_original": F.nullif(original, F.lit("")),
            "nacao_componentes": F.array().cast("array<string>"),
            "nacao_primaria": F.lit(None).cast("string"),
            "nacao_categoria": F.when(missing, UNDECLARED).otherwise(display),
            "metodo_classificacao": F.when(missing, ABSENT).otherwise(LITERAL),
        }
    )


@dataclass(frozen=True)
class RuleSet:
    """Rules of one classifier: protective terms, ordered (label, pattern) rules, place names and how they are suffixed."""

    protective: list[str] = field(default_factory=list)
    labelled: list[tuple[str, str]] = field(default_factory=list)
    blocking: list[str] = field(default_factory=list)
    places: list[str] = field(default_factory=list)
    place_label: str = "Nome de município"
    default_label: str = "Sem palavra-chave"


def is_place(name: Column, places: list[str], chained: bool) -> Column:
    """Whether a name is nothing but a place.

    ``chained`` first removes ' ba', '-ba' and the like wherever they stand, one after another; else a place matches plainly
    or with one of six endings.
    """
    clean = stripped(F.lower(name))
    if chained:
        bare = clean
        for ending in (" ba", "-ba", " bahia", ", bahia", ", ba"):
            bare = F.replace(bare, F.lit(ending), F.lit(""))
        return clean.isin(places) | stripped(bare).isin(places)
    return clean.isin([p + ending for p in places for ending in ("", " ba", " bahia", "-ba", ", bahia", " ba.")])


def scan_buckets(df: DataFrame, name: str, rules: RuleSet) -> DataFrame:
    """Adds ``bucket`` and ``razao`` in one pass; the order of the tests is the contract.

    Protected names are 'real', then the first labelled rule makes a 'suspect', then a bare place does, and the rest is 'ambiguous'. Names are
    tested without white space at their ends; null and blank ones are in no bucket: both columns are null.
    """
    text = stripped(F.col(name))
    named = F.coalesce(text != "", F.lit(False))
    protected, label, place = contains_any(text, rules.protective), first_label(text, rules.labelled), is_place(text, rules.places, chained=True)
    bucket = F.when(~named, None).when(protected, "real").when(label.isNotNull() | place, "suspect").otherwise("ambiguous")
    reason = F.when(~named | protected, None).when(label.isNotNull(), label).when(place, rules.place_label).otherwise(rules.default_label)
    return df.withColumns({"bucket": bucket, "razao": reason})


def refine_ambiguous(df: DataFrame, name: str, keep: list[str], rules: RuleSet) -> DataFrame:
    """Adds ``decisao`` ('manter' or 'remover') and ``razao``: kept by a term, else removed by the first rule, else by default."""
    kept = F.coalesce(contains_any(F.col(name), keep), F.lit(False))
    return df.withColumns({"decisao": F.when(kept, "manter").otherwise("remover"), "razao": F.when(~kept, F.coalesce(first_label(F.col(name), rules.labelled), F.lit(rules.default_label)))})


def removal_reason(df: DataFrame, name: str, suspects: DataFrame, rules: RuleSet) -> DataFrame:
    """Adds ``remover`` and ``razao``: exact suspect (case counts, before any protection), protection, blocking term, bare place.

    ``suspects`` has the names under ``name``; its doubles don't multiply rows. White space at the ends doesn't count. Null names are kept.
    """
    listed = suspects.select(stripped(F.col(name)).alias("_s")).filter(F.col("_s").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    marked = df.join(listed, stripped(F.col(name)) == F.col("_s"), "left").drop("_s")
    term = first_contained(F.col(name), rules.blocking)
    reason = (
        F.when(F.col("_hit"), "Suspeito exato")
        .when(contains_any(F.col(name), rules.protective), None)
        .when(term.isNotNull(), F.concat(F.lit("KW: "), term))
        .when(is_place(F.col(name), rules.places, chained=False), rules.place_label)
    )
    return marked.withColumn("razao", reason).withColumn("remover", F.col("razao").isNotNull()).drop("_hit")
