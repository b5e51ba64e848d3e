"""Records of a source made into records of the registry, and maps of metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartoria.functions.geo import geo_status, in_box
from cartoria.functions.values import by_key, number


def normalized_primary(df: DataFrame, source: str, detail: str, id: str = "id", own_id: str = "ceao_id", raw: str = "raw_html", lat: str = "lat", lng: str = "lng") -> DataFrame:
    """The primary source's rows as registry records: the raw page dropped, ``id`` as text under ``own_id``, constant source columns, ``geo_status`` and provenance.

    An ``id`` that is null gives the row's own ``own_id`` if it has that column, else ''.
    """
    given = [F.col(c).cast("string") for c in (id, own_id) if c in df.columns]
    key = F.coalesce(*given, F.lit(""))
    kept = df.withColumn("_key", key).drop(raw, id)
    return kept.withColumns({
        own_id: F.col("_key"), "fonte": F.lit(source), "fonte_detalhe": F.lit(detail), "geo_status": geo_status(F.col(lat), F.col(lng)),
        "fontes": F.array(F.struct(F.lit(source).alias("fonte"), F.col("_key").alias("id"))),
    }).drop("_key")


# The properties of a narrow feature, each with the keys it may come from, in their order.
ALIASES = {"nome": ["nome", "name"], "fonte": ["fonte"], "nacao": ["nacao", "tradicao", "nao"], "endereco": ["endereco", "address"], "municipio": ["municipio", "addr:city", "cidade"]}


def narrow_features(df: DataFrame, fields: str) -> DataFrame:
    """Rows with a point in the box, from a map of their fields as text: ``lng, lat`` and the properties of ``ALIASES``.

    A property is that of the first key that is present, null if it is null there; '' where none is. Columns beside the map stay.
    """
    point = {c: number(F.try_element_at(F.col(fields), F.lit(c))) for c in ("lng", "lat")}
    read = df.withColumns({**point, **{name: by_key(F.col(fields), *keys, default=F.lit("")) for name, keys in ALIASES.items()}})
    return read.filter(in_box(F.col("lat"), F.col("lng"))).withColumn("geo_status", F.lit("in_bahia")).drop(fields)


def merged_map(old: Column, new: Column) -> Column:
    """A map with the entries of both, ``new`` over ``old``; a null map has no entries."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    o, n = F.coalesce(old, empty), F.coalesce(new, empty)
    return F.map_concat(F.map_filter(o, lambda k, _: ~F.map_contains_key(n, k)), n)


def rules_table(df: DataFrame, kind: str) -> list[tuple[str, str]]:
    """The (label, pattern) rules of one ``kind`` from a table ``kind, ord, label, pattern``, in order. Rules are data of a registry, few enough for the driver: more than 100,000 are refused."""
    rows = df.filter(F.col("kind") == kind).orderBy("ord").select("label", "pattern").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("too many rules")
    return [(r["label"], r["pattern"]) for r in rows]
