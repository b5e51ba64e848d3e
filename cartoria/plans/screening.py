"""Screening names by rules: buckets, labels, removals and their propagation, each with its reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartoria.functions.text import contains_any, first_label, stripped, valid_rules
from cartoria.operators.audit import percentage
from cartoria.operators.classify import RuleSet, is_place, refine_ambiguous, removal_reason, scan_buckets
from cartoria.plans.rules import BLOCKING, BROKEN, KEEP, LABELLED, PLACES, PROTECTIVE, RULES
from cartoria.sources.tables import table


def names(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "terreiros_all_sources_v2").select("pos", "fonte", "nome", "municipio")


def google_names(spark: SparkSession, directory: str) -> DataFrame:
    return names(spark, directory).filter(F.col("fonte") == "google")


def protective_terms(spark: SparkSession, directory: str) -> DataFrame:
    return names(spark, directory).filter(F.col("nome").isNotNull()).select("pos", contains_any(F.col("nome"), PROTECTIVE).alias("protegido"))


def first_match_label(spark: SparkSession, directory: str) -> DataFrame:
    """The first of the rules that compile; the broken one is reported and left out."""
    rules, _ = valid_rules(spark, [*LABELLED[:3], BROKEN, *LABELLED[3:]])
    return names(spark, directory).select("pos", first_label(F.col("nome"), rules).alias("rotulo")).filter(F.col("rotulo").isNotNull())


def municipality_match(spark: SparkSession, directory: str) -> DataFrame:
    """Texts that are only a place, by both suffix rules."""
    towns = names(spark, directory).filter(F.col("municipio").isNotNull())
    text = F.when(F.col("pos") % 3 == 0, F.concat("municipio", F.lit(" - BA"))).when(F.col("pos") % 3 == 1, F.concat("municipio", F.lit(" BA"))).otherwise(F.col("municipio"))
    return towns.select("pos", is_place(text, PLACES, chained=True).alias("encadeado"), is_place(text, PLACES, chained=False).alias("por_sufixo"))


def scan_buckets_query(spark: SparkSession, directory: str) -> DataFrame:
    return scan_buckets(google_names(spark, directory), "nome", RULES).select("pos", "bucket", "razao")


def scan_summary(spark: SparkSession, directory: str) -> DataFrame:
    """The scan in one row: four counts and a rate."""
    rows = names(spark, directory)
    scanned = scan_buckets(rows.filter(F.col("fonte") == "google"), "nome", RULES).agg(
        F.count_if(F.col("bucket") == "real").alias("reais"), F.count_if(F.col("bucket") == "suspect").alias("suspeitos"), F.count_if(F.col("bucket") == "ambiguous").alias("ambiguos"), F.count("*").alias("total")
    )
    return scanned.withColumn("taxa", percentage(F.col("suspeitos"), F.col("total")))


def scan_ranking(spark: SparkSession, directory: str) -> DataFrame:
    """The reasons by count, at most twenty, ties by name."""
    counts = scan_buckets(google_names(spark, directory), "nome", RULES).filter(F.col("razao").isNotNull()).groupBy("razao").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "razao").limit(20)


def refine_query(spark: SparkSession, directory: str) -> DataFrame:
    ambiguous = scan_buckets(google_names(spark, directory), "nome", RULES).filter(F.col("bucket") == "ambiguous").drop("razao")
    return refine_ambiguous(ambiguous, "nome", KEEP, RuleSet(labelled=LABELLED, default_label="Não religioso (padrão)")).select("pos", "decisao", "razao")


def suspects(spark: SparkSession, directory: str) -> DataFrame:
    return scan_buckets(google_names(spark, directory), "nome", RULES).filter(F.col("bucket") == "suspect").select(stripped(F.col("nome")).alias("nome"))


def remover_labels(spark: SparkSession, directory: str) -> DataFrame:
    """Rows to remove, with the rule that says so."""
    rules = RuleSet(protective=PROTECTIVE[:4], blocking=BLOCKING, places=PLACES)
    return removal_reason(names(spark, directory).filter(F.col("nome").isNotNull()), "nome", suspects(spark, directory), rules).select("pos", "remover", "razao")


def removal_propagation(spark: SparkSession, directory: str) -> DataFrame:
    """What stays when the suspects' names are removed from two sources: by name alone, so namesakes go too."""
    gone = suspects(spark, directory).distinct()
    rows = names(spark, directory)
    reached = rows.filter(F.col("fonte").isin("google", "osm")).join(gone.withColumnRenamed("nome", "_gone"), stripped(F.col("nome")) == F.col("_gone"), "left_anti")
    return reached.unionByName(rows.filter(~F.coalesce(F.col("fonte").isin("google", "osm"), F.lit(False))), allowMissingColumns=True).select("pos", "fonte", "nome")


QUERIES = {
    "protective_terms": protective_terms, "first_match_label": first_match_label, "municipality_match": municipality_match, "scan_buckets": scan_buckets_query, "scan_summary": scan_summary,
    "scan_ranking": scan_ranking, "refine_ambiguous": refine_query, "remover_labels": remover_labels, "removal_propagation": removal_propagation,
}


from cartoria.plans.registry import strip_sql  # noqa: E402


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.lower().replace("'", "''") + "'" for w in words)


def any_sql(column: str, terms: list[str]) -> str:
    return f"len(list_filter([{quoted(terms)}], lambda t: contains(lower({column}), t))) > 0"


def label_sql(column: str) -> str:
    cases = " ".join(f"WHEN regexp_matches(lower({column}), '{pattern}') THEN '{label}'" for label, pattern in LABELLED)
    return f"CASE {cases} END"


def place_sql(x: str, chained: bool) -> str:
    if chained:
        bare = f"trim(lower({x}))"
        for ending in (" ba", "-ba", " bahia", ", bahia", ", ba"):
            bare = f"replace({bare}, '{ending}', '')"
        return f"(trim(lower({x})) IN ({quoted(PLACES)}) OR trim({bare}) IN ({quoted(PLACES)}))"
    return f"trim(lower({x})) IN ({quoted([p + e for p in PLACES for e in ('', ' ba', ' bahia', '-ba', ', bahia', ' ba.')])})"


SCAN = f"""g AS (SELECT pos, fonte, {strip_sql('nome')} AS nome FROM terreiros_all_sources_v2 WHERE fonte = 'google'),
x AS (SELECT *, coalesce(nome, '') <> '' AS named, {any_sql('nome', PROTECTIVE)} AS p, {label_sql('nome')} AS l, {place_sql('nome', True)} AS m FROM g),
s AS (SELECT pos, nome, CASE WHEN NOT named THEN NULL WHEN p THEN 'real' WHEN l IS NOT NULL OR m THEN 'suspect' ELSE 'ambiguous' END AS bucket,
  CASE WHEN NOT named OR p THEN NULL WHEN l IS NOT NULL THEN l WHEN m THEN 'Nome de município' ELSE 'Sem palavra-chave' END AS razao FROM x)"""
TEXT = "CASE pos % 3 WHEN 0 THEN municipio || ' - BA' WHEN 1 THEN municipio || ' BA' ELSE municipio END"

SQL = {
    "protective_terms": f"SELECT pos, {any_sql('nome', PROTECTIVE)} AS protegido FROM terreiros_all_sources_v2 WHERE nome IS NOT NULL",
    "first_match_label": f"SELECT pos, rotulo FROM (SELECT pos, {label_sql('nome')} AS rotulo FROM terreiros_all_sources_v2) WHERE rotulo IS NOT NULL",
    "municipality_match": f"SELECT pos, {place_sql('t', True)} AS encadeado, {place_sql('t', False)} AS por_sufixo FROM (SELECT pos, {TEXT} AS t FROM terreiros_all_sources_v2 WHERE municipio IS NOT NULL)",
    "scan_buckets": f"WITH {SCAN} SELECT pos, bucket, razao FROM s",
    "scan_summary": f"""WITH {SCAN} SELECT count(*) FILTER (bucket = 'real') AS reais, count(*) FILTER (bucket = 'suspect') AS suspeitos, count(*) FILTER (bucket = 'ambiguous') AS ambiguos, count(*) AS total,
  printf('%.1f%%', count(*) FILTER (bucket = 'suspect') * 100.0::DOUBLE / greatest(count(*), 1)) AS taxa FROM s""",
    "scan_ranking": f"WITH {SCAN} SELECT razao, count(*) AS n FROM s WHERE razao IS NOT NULL GROUP BY 1 ORDER BY n DESC, razao LIMIT 20",
    "refine_ambiguous": f"""WITH {SCAN} SELECT pos, CASE WHEN {any_sql('nome', KEEP)} THEN 'manter' ELSE 'remover' END AS decisao,
  CASE WHEN {any_sql('nome', KEEP)} THEN NULL ELSE coalesce({label_sql('nome')}, 'Não religioso (padrão)') END AS razao FROM s WHERE bucket = 'ambiguous'""",
    "remover_labels": f"""WITH {SCAN}, r AS (SELECT pos, CASE WHEN {strip_sql('nome')} IN (SELECT nome FROM s WHERE bucket = 'suspect') THEN 'Suspeito exato' WHEN {any_sql('nome', PROTECTIVE[:4])} THEN NULL
  WHEN len(list_filter([{quoted(BLOCKING)}], lambda t: contains(lower(nome), t))) > 0 THEN 'KW: ' || list_filter([{quoted(BLOCKING)}], lambda t: contains(lower(nome), t))[1]
  WHEN {place_sql('nome', False)} THEN 'Nome de município' END AS razao FROM terreiros_all_sources_v2 WHERE nome IS NOT NULL) SELECT pos, razao IS NOT NULL AS remover, razao FROM r""",
    "removal_propagation": f"WITH {SCAN} SELECT pos, fonte, nome FROM terreiros_all_sources_v2 t WHERE NOT (coalesce(fonte IN ('google', 'osm'), false) AND EXISTS (SELECT 1 FROM s WHERE bucket = 'suspect' AND s.nome = {strip_sql('t.nome')}))",
}
