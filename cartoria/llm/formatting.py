"""Problem 7: duplicates hidden by formatting differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartoria.functions.lineage import cut
from cartoria.operators.skew import hot_keys, small
from cartoria.sources.tables import table


def words_key(text: Column) -> Column:
    """The words of a text, lower case and sorted, each as often as it occurs; null and wordless texts give ''.

    Letters, accents (also ones stored apart) and digits make words; everything else separates them.
    """
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.array_join(F.array_sort(F.filter(words, lambda w: w != "")), " ")


def collapse_copies(df: DataFrame, id: str, keys: list[str], hot: int = 10_000, salts: int = 64) -> DataFrame:
    """Groups of rows with equal ``keys``: ``id``, ``first`` (the smallest id of its group) and ``copies`` (rows in it).

    One row for each input row whose group has more than one. Null equals null and NaN equals NaN.

    1. Partial counts by a 64-bit hash of the keys find every key with more than ``hot`` rows (``hot_keys``). The counts
       are exact; two keys that share a hash are at worst both called hot, which changes no result.
    2. Rows of hot keys are told by a join with the few hot hashes, broadcast if a count shows that they are few, so they never meet in one
       exchange; they are aggregated in two levels, first with one of ``salts`` salts, and get their group's figures back from the hot groups.
    3. The other rows are shuffled once: their groups are small enough to carry their ids as a list.
    An empty table gives no rows. Columns beside ``id`` and ``keys`` are not read.
    """
    rows = df.select(F.col(id).alias("_id"), F.xxhash64(*keys).alias("_h"), *[F.col(k) for k in keys])
    heavy = hot_keys(rows, ["_h"], hot)
    marked = rows.withColumn("_hot", F.lit(False)) if heavy is None else rows.join(small(heavy.select("_h", F.lit(True).alias("_hot"))), "_h", "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    listed = (
        marked.filter(~F.col("_hot"))
        .groupBy("_h", *keys)
        .agg(F.collect_list("_id").alias("ids"))
        .filter(F.size("ids") > 1)
        .select(F.explode("ids").alias("id"), F.array_min("ids").alias("first"), F.size("ids").cast("long").alias("copies"))
    )
    if heavy is None:
        return listed
    large = marked.filter("_hot")
    groups = cut(
        large.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
        .groupBy("_h", *keys, "_salt")
        .agg(F.min("_id").alias("first"), F.count("*").alias("copies"))
        .groupBy("_h", *keys)
        .agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
        .filter(F.col("copies") > 1)
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"g.{k}"))
    back = large.alias("l").join(small(groups).alias("g"), (F.col("l._h") == F.col("g._h")) & same).select(F.col("l._id").alias("id"), "first", "copies")
    return listed.unionByName(back)


def keyed_rows(spark: SparkSession, directory: str) -> DataFrame:
    """The rows of both tables under one schema, with the words of their names."""
    places = table(spark, directory, "terreiros_all_sources_v2").select(
        F.lit("terreiros_all_sources_v2").alias("tabela"), "pos", words_key(F.col("nome")).alias("palavras"),
        "fonte", "coletado_em", "municipio", F.col("lat").alias("y"), F.col("lng").alias("x"), F.lit(None).cast("string").alias("endereco"),
    )
    queue = table(spark, directory, "revisao_google").select(
        F.lit("revisao_google").alias("tabela"), "pos", words_key(F.col("nome")).alias("palavras"),
        F.lit(None).cast("string").alias("fonte"), F.lit(None).cast(places.schema["coletado_em"].dataType).alias("coletado_em"), F.lit(None).cast("string").alias("municipio"),
        F.col("latitude").alias("y"), F.col("longitude").alias("x"), "endereco",
    )
    return places.unionByName(queue)


KEYS = ["tabela", "palavras", "fonte", "coletado_em", "municipio", "y", "x", "endereco"]


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    """One row for each copy: the smallest ``pos`` of its set and its own."""
    rows = keyed_rows(spark, directory)
    both = rows.withColumn("chave", F.struct(F.col("pos"), F.col("tabela")))
    found = collapse_copies(both, "chave", KEYS)
    return found.filter(F.col("id.pos") > F.col("first.pos")).select(F.col("id.tabela").alias("tabela"), F.col("first.pos").alias("pos_a"), F.col("id.pos").alias("pos_b"))


def p7_survivors(spark: SparkSession, directory: str) -> DataFrame:
    """One row for each set of copies: its representative, the smallest ``pos``, and the number of its rows, 1 or more."""
    return keyed_rows(spark, directory).groupBy(*KEYS).agg(F.min("pos").alias("pos"), F.count("*").alias("copias")).select("tabela", "pos", "copias")


QUERIES = {"p7_found": p7_found, "p7_survivors": p7_survivors}

WORDS = r"array_to_string(list_sort(list_filter(regexp_split_to_array(lower(coalesce(nome, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '')), ' ')"
SETS = f"""
WITH k AS (
  SELECT 'terreiros_all_sources_v2' AS tabela, pos, {WORDS} AS w, fonte AS a, coletado_em::VARCHAR AS b, municipio AS c, lat AS y, lng AS x FROM terreiros_all_sources_v2
  UNION ALL SELECT 'revisao_google', pos, {WORDS}, endereco, NULL, NULL, latitude, longitude FROM revisao_google
)"""
SQL = {
    "p7_found": SETS + ", n AS (SELECT tabela, pos, min(pos) OVER (PARTITION BY tabela, w, a, b, c, y, x) AS pos_a FROM k) SELECT tabela, pos_a, pos AS pos_b FROM n WHERE pos > pos_a",
    "p7_survivors": SETS + " SELECT tabela, min(pos) AS pos, count(*) AS copias FROM k GROUP BY tabela, w, a, b, c, y, x",
}
