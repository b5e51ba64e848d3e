"""Publishing the registry: labels, bounding box, exclusions, histograms, samples, audit, features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartoria.functions.geo import feature, geo_status, in_box
from cartoria.functions.text import folded, stripped
from cartoria.functions.values import first_truthy, number, rounded
from cartoria.operators.audit import histogram, histogram_map, over_fixed, percentage, reconciled
from cartoria.operators.classify import with_nation
from cartoria.operators.keyed import excluded, first_wins, overlaid, ranked_first, split_by
from cartoria.sources.tables import table

SOURCES = ["ceao", "google", "osm", "sefaz"]


def registry(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "terreiros_all_sources_v2")


def nation_classify(spark: SparkSession, directory: str) -> DataFrame:
    rows = with_nation(registry(spark, directory).select("pos", "nacao"))
    return rows.select("pos", "nacao_original", "nacao_categoria", "metodo_classificacao", F.size("nacao_componentes").alias("componentes"), "nacao_primaria")


def bbox_filter(spark: SparkSession, directory: str) -> DataFrame:
    return registry(spark, directory).filter(in_box(F.col("lat"), F.col("lng"))).select("pos", "fonte", "lat", "lng")


def geo_status_query(spark: SparkSession, directory: str) -> DataFrame:
    return registry(spark, directory).select("pos", geo_status(F.col("lat"), F.col("lng")).alias("geo_status"))


def source_name() -> Column:
    """Null and '' are the unknown source."""
    return first_truthy(F.col("fonte"), default=F.lit("desconhecida"))


def source_told() -> Column:
    """Only null, an absent source, is the unknown one; '' is a source of its own in histograms."""
    return F.coalesce("fonte", F.lit("desconhecida"))


def source_histogram(spark: SparkSession, directory: str) -> DataFrame:
    mapped = F.count_if(in_box(F.col("lat"), F.col("lng")))
    return registry(spark, directory).groupBy(source_told().alias("fonte")).agg(F.count("*").alias("n"), mapped.alias("mapeados"))


def category_histogram(spark: SparkSession, directory: str) -> DataFrame:
    """Ranked by count; first-seen decides ties, so ``rank`` has no doubles. The histogram is small, the rank is one task's work."""
    counts = histogram(with_nation(registry(spark, directory).select("pos", "nacao")), F.col("nacao_categoria"), "categoria", "pos")
    from pyspark.sql import Window as W

    return counts.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n"), "first")).cast("long")).select("categoria", "n", "first", "rank")


def exclusion_keys() -> tuple[list[Column], list[Column]]:
    """Name without case, and both coordinates at six digits, on the records' side and on the ledger's."""
    own = [folded(stripped(F.coalesce("nome", F.lit("")))), rounded(F.col("lat")), rounded(F.col("lng"))]
    listed = [folded(stripped(F.coalesce("nome", F.lit("")))), rounded(number(F.col("latitude"))), rounded(number(F.col("longitude")))]
    return own, listed


def exclusion_anti(spark: SparkSession, directory: str) -> DataFrame:
    """Records that aren't in the ledger of exclusions; the primary source is never excluded, nor are records without a point."""
    own, listed = exclusion_keys()
    primary, others = split_by(registry(spark, directory), F.col("fonte") == "ceao")
    kept = excluded(others, table(spark, directory, "exclusoes_curadas"), own, listed)
    return primary.unionByName(kept).select("pos", "fonte", "nome")


def publish_slice(spark: SparkSession, directory: str) -> DataFrame:
    """The whole publication in one plan: labels, exclusions, union, box, counts by category."""
    own, listed = exclusion_keys()
    rows = registry(spark, directory).select("pos", "fonte", "nome", "nacao", "lat", "lng")
    primary, others = split_by(rows, F.col("fonte") == "ceao")
    kept = primary.unionByName(excluded(others, table(spark, directory, "exclusoes_curadas"), own, listed))
    labelled = with_nation(kept)
    return labelled.groupBy("nacao_categoria").agg(F.count("*").alias("registros"), F.count_if(in_box(F.col("lat"), F.col("lng"))).alias("mapeados"), F.min("pos").alias("primeiro"))


def previous_overlay(spark: SparkSession, directory: str) -> DataFrame:
    """Each ceao id's first row with rating and reviews of the last google row of its name: an overlay where later values win."""
    rows = registry(spark, directory)
    mine = first_wins(rows.filter((F.col("fonte") == "ceao") & F.col("ceao_id").isNotNull()).select("ceao_id", "pos", "nome", "rating", "reviews"), ["ceao_id"], "pos")
    previous = rows.filter((F.col("fonte") == "google") & F.col("nome").isNotNull()).select("nome", F.col("pos").alias("ordem"), "rating", "reviews")
    return overlaid(mine.select("ceao_id", "nome", "rating", "reviews"), previous, ["nome"], ["rating", "reviews"], "ordem").withColumn("reviews", F.col("reviews").cast("double"))


def human_review_sample(spark: SparkSession, directory: str) -> DataFrame:
    """The first ten mapped records of each category, with the id of the source or, as a last resort, the position."""
    mapped = with_nation(registry(spark, directory).filter(in_box(F.col("lat"), F.col("lng"))).select("pos", "fonte", "ceao_id", "place_id", "osm_id", "sefaz_codigo", "nome", "nacao"))
    sample = ranked_first(mapped, ["nacao_categoria"], [F.col("pos")], 10)
    return sample.select(
        "pos", source_name().alias("fonte"), first_truthy(F.col("ceao_id"), F.col("place_id"), F.col("osm_id"), F.col("sefaz_codigo"), default=F.col("pos").cast("string")).alias("id_fonte"),
        "nome", "nacao_original", F.to_json("nacao_componentes").alias("nacao_componentes"), "nacao_categoria", "metodo_classificacao",
        F.lit("pendente").alias("status_revisao"), F.lit("").alias("decisao_revisor"), F.lit("").alias("observacoes"), F.col("rank").cast("long").alias("rank"),
    )


def audit_reconciliation(spark: SparkSession, directory: str) -> DataFrame:
    """One row of counts that have to add up.

    The primary source is ceao: its deliveries are what was extracted, its ids what is represented, and the version before had those ids that were collected with a point.
    """
    rows = registry(spark, directory)
    box = in_box(F.col("lat"), F.col("lng"))
    primary = (F.col("fonte") == "ceao") & F.col("ceao_id").isNotNull()
    counts = rows.agg(F.count("*").alias("total_registros"), F.count_if(box).alias("total_georreferenciados"), F.count_if(~F.col("fonte").eqNullSafe("ceao")).alias("complementares"))
    before = rows.filter(primary & box).select("ceao_id").distinct()
    now = rows.filter(primary).select("ceao_id")
    sample = human_review_sample(spark, directory).agg(F.count("*").alias("amostra"))
    ledger = table(spark, directory, "exclusoes_curadas").select(*[k.alias(f"k{i}") for i, k in enumerate(exclusion_keys()[1])]).distinct().agg(F.count("*").alias("exclusoes"))
    return counts.crossJoin(reconciled(now, before, "ceao_id")).crossJoin(sample).crossJoin(ledger)  # one row each


def before_after_by_source(spark: SparkSession, directory: str) -> DataFrame:
    """Counts of a fixed list of sources before and after the exclusions; what never occurs counts 0."""
    own, listed = exclusion_keys()
    rows = registry(spark, directory)
    key = first_truthy(F.col("fonte"), default=F.lit("(vazio)"))
    before = rows.groupBy(key.alias("fonte")).agg(F.count("*").alias("antes"))
    after = excluded(rows, table(spark, directory, "exclusoes_curadas"), own, listed).groupBy(key.alias("fonte")).agg(F.count("*").alias("depois"))
    return over_fixed(before.join(after, "fonte", "full"), "fonte", [*SOURCES, "wikidata", "(vazio)"], ["antes", "depois"])


def rate_summary(spark: SparkSession, directory: str) -> DataFrame:
    rows = registry(spark, directory)
    box = in_box(F.col("lat"), F.col("lng"))
    return rows.groupBy(source_name().alias("fonte")).agg(F.count("*").alias("total"), F.count_if(box).alias("parte")).withColumn("taxa", percentage(F.col("parte"), F.col("total")))


def feature_geojson(spark: SparkSession, directory: str) -> DataFrame:
    """Mapped records as features; properties are all columns but the coordinates."""
    rows = registry(spark, directory).filter(in_box(F.col("lat"), F.col("lng")))
    made = rows.select("pos", feature(F.col("lat"), F.col("lng"), F.struct(*[c for c in rows.columns if c not in ("lat", "lng")])).alias("f"))
    return made.select("pos", F.col("f.type").alias("tipo"), F.col("f.geometry.coordinates")[0].alias("x"), F.col("f.geometry.coordinates")[1].alias("y"), F.col("f.properties.nome").alias("nome"), F.size(F.json_object_keys(F.to_json("f.properties", {"ignoreNullFields": "false"}))).alias("propriedades"))


def provenance_array(spark: SparkSession, directory: str) -> DataFrame:
    made = F.array(F.struct(source_name().alias("fonte"), first_truthy(F.col("ceao_id"), F.col("place_id"), F.col("osm_id"), F.col("sefaz_codigo")).alias("id")))
    return registry(spark, directory).select("pos", made.alias("fontes")).select("pos", F.size("fontes").alias("n"), F.col("fontes")[0]["fonte"].alias("fonte"), F.col("fontes")[0]["id"].alias("id"))


def histogram_map_query(spark: SparkSession, directory: str) -> DataFrame:
    """The histogram by source as one map, read again entry by entry."""
    counts = histogram(registry(spark, directory), source_told(), "fonte")
    return histogram_map(counts, "fonte").select(F.posexplode(F.map_entries("histogram")).alias("ordem", "e")).select("ordem", F.col("e.key").alias("fonte"), F.col("e.value").alias("n"))


def source_dedupe_first(spark: SparkSession, directory: str) -> DataFrame:
    """Repeated deliveries collapse to the first of each (source, id); rows without an id stay as they are."""
    rows = registry(spark, directory).select("fonte", first_truthy(F.col("ceao_id"), F.col("place_id"), F.col("osm_id"), F.col("sefaz_codigo")).alias("id"), "pos", "nome")
    once = first_wins(rows.filter(F.col("id") != ""), ["fonte", "id"], "pos")
    return once.unionByName(rows.filter(F.col("id") == "")).select("pos", "fonte", "id", "nome")


QUERIES = {
    "nation_classify": nation_classify, "bbox_filter": bbox_filter, "geo_status": geo_status_query, "source_histogram": source_histogram, "category_histogram": category_histogram,
    "exclusion_anti": exclusion_anti, "publish_slice": publish_slice, "previous_overlay": previous_overlay, "human_review_sample": human_review_sample,
    "audit_reconciliation": audit_reconciliation, "before_after_by_source": before_after_by_source, "rate_summary": rate_summary,
    "feature_geojson": feature_geojson, "provenance_array": provenance_array, "histogram_map": histogram_map_query, "source_dedupe_first": source_dedupe_first,
}

SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


NATION_CTE = f"""n AS (
  SELECT *, {strip_sql('nacao')} AS o, regexp_replace({strip_sql('nacao')}, '{SPACE}+', ' ', 'g') AS d FROM terreiros_all_sources_v2
), c AS (
  SELECT * EXCLUDE (nacao_original, nacao_categoria, metodo_classificacao), nullif(o, '') AS nacao_original,
    CASE WHEN d IS NULL OR d = '' OR lower(d) IN ('não informado', 'nao informado', 'não informada', 'nao informada', 'sem informação', 'sem informacao') THEN 'Não informado' ELSE d END AS nacao_categoria,
    CASE WHEN d IS NULL OR d = '' OR lower(d) IN ('não informado', 'nao informado', 'não informada', 'nao informada', 'sem informação', 'sem informacao') THEN 'ausente-v2.1' ELSE 'declarado-literal-v2.1' END AS metodo_classificacao
  FROM n
)"""
BOX = "lat BETWEEN -18.5 AND -8.0 AND lng BETWEEN -47.0 AND -37.0"
UNKNOWN = "coalesce(nullif(fonte, ''), 'desconhecida')"
OWN_ID = "coalesce(nullif(ceao_id, ''), nullif(place_id, ''), nullif(osm_id, ''), nullif(sefaz_codigo, ''){0})"


def ledger_sql(exempt: str) -> str:
    return f"""l AS (
  SELECT DISTINCT lower({strip_sql("coalesce(nome, '')")}) AS k, round(try_cast(latitude AS DOUBLE), 6) AS a, round(try_cast(longitude AS DOUBLE), 6) AS b FROM exclusoes_curadas
), kept AS (
  SELECT t.* FROM terreiros_all_sources_v2 t WHERE {exempt} NOT EXISTS (SELECT 1 FROM l WHERE l.k = lower({strip_sql("coalesce(t.nome, '')")}) AND l.a = round(t.lat, 6) AND l.b = round(t.lng, 6))
)"""


SQL = {
    "nation_classify": f"WITH {NATION_CTE} SELECT pos, nacao_original, nacao_categoria, metodo_classificacao, 0 AS componentes, NULL::VARCHAR AS nacao_primaria FROM c",
    "bbox_filter": f"SELECT pos, fonte, lat, lng FROM terreiros_all_sources_v2 WHERE {BOX}",
    "geo_status": f"SELECT pos, CASE WHEN {BOX} THEN 'in_bahia' ELSE 'out_of_bahia' END AS geo_status FROM terreiros_all_sources_v2",
    "source_histogram": f"SELECT coalesce(fonte, 'desconhecida') AS fonte, count(*) AS n, count(*) FILTER ({BOX}) AS mapeados FROM terreiros_all_sources_v2 GROUP BY 1",
    "category_histogram": f"WITH {NATION_CTE}, h AS (SELECT nacao_categoria AS categoria, count(*) AS n, min(pos) AS first FROM c GROUP BY 1) SELECT *, row_number() OVER (ORDER BY n DESC, first) AS rank FROM h",
    "exclusion_anti": f"WITH {ledger_sql("t.fonte = 'ceao' OR")} SELECT pos, fonte, nome FROM kept",
    "publish_slice": f"WITH {NATION_CTE}, {ledger_sql("t.fonte = 'ceao' OR")} SELECT nacao_categoria, count(*) AS registros, count(*) FILTER ({BOX}) AS mapeados, min(pos) AS primeiro FROM c WHERE pos IN (SELECT pos FROM kept) GROUP BY 1",
    "previous_overlay": """
WITH m AS (SELECT ceao_id, arg_min({n: nome, r: rating, v: reviews}, pos) AS s FROM terreiros_all_sources_v2 WHERE fonte = 'ceao' AND ceao_id IS NOT NULL GROUP BY 1),
p AS (SELECT nome, arg_max({r: rating, v: reviews}, pos) AS s FROM terreiros_all_sources_v2 WHERE fonte = 'google' AND nome IS NOT NULL GROUP BY 1)
SELECT ceao_id, m.s.n AS nome, coalesce(p.s.r, m.s.r) AS rating, coalesce(p.s.v, m.s.v)::DOUBLE AS reviews FROM m LEFT JOIN p ON m.s.n = p.nome""",
    "human_review_sample": f"""
WITH {NATION_CTE}, r AS (SELECT *, row_number() OVER (PARTITION BY nacao_categoria ORDER BY pos) AS rank FROM c WHERE {BOX})
SELECT pos, {UNKNOWN} AS fonte, {OWN_ID.format(", pos::VARCHAR")} AS id_fonte, nome, nacao_original, '[]' AS nacao_componentes, nacao_categoria, metodo_classificacao, 'pendente' AS status_revisao, '' AS decisao_revisor, '' AS observacoes, rank FROM r WHERE rank <= 10""",
    "audit_reconciliation": f"""
WITH {NATION_CTE}, p AS (SELECT * FROM terreiros_all_sources_v2 WHERE fonte = 'ceao' AND ceao_id IS NOT NULL), v1 AS (SELECT DISTINCT ceao_id FROM p WHERE {BOX}),
s AS (SELECT row_number() OVER (PARTITION BY nacao_categoria ORDER BY pos) AS rank FROM c WHERE {BOX}),
l AS (SELECT DISTINCT lower({strip_sql("coalesce(nome, '')")}) AS k, round(try_cast(latitude AS DOUBLE), 6) AS a, round(try_cast(longitude AS DOUBLE), 6) AS b FROM exclusoes_curadas)
SELECT (SELECT count(*) FROM terreiros_all_sources_v2) AS total_registros, (SELECT count(*) FROM terreiros_all_sources_v2 WHERE {BOX}) AS total_georreferenciados,
  (SELECT count(*) FROM terreiros_all_sources_v2 WHERE fonte IS DISTINCT FROM 'ceao') AS complementares, (SELECT count(*) FROM p) AS extraidos, (SELECT count(DISTINCT ceao_id) FROM p) AS ids_unicos,
  (SELECT count(*) FROM v1) AS presentes_na_v1, (SELECT count(DISTINCT ceao_id) FROM p WHERE ceao_id NOT IN (SELECT ceao_id FROM v1)) AS adicionados_na_v2, (SELECT count(*) FROM v1 WHERE ceao_id NOT IN (SELECT ceao_id FROM p)) AS ausentes,
  (SELECT count(*) FROM s WHERE rank <= 10) AS amostra, (SELECT count(*) FROM l) AS exclusoes""",
    "before_after_by_source": f"""
WITH {ledger_sql("")}, f(ord, fonte) AS (VALUES (0, 'ceao'), (1, 'google'), (2, 'osm'), (3, 'sefaz'), (4, 'wikidata'), (5, '(vazio)'))
SELECT ord, fonte, (SELECT count(*) FROM terreiros_all_sources_v2 t WHERE coalesce(nullif(t.fonte, ''), '(vazio)') = f.fonte) AS antes, (SELECT count(*) FROM kept t WHERE coalesce(nullif(t.fonte, ''), '(vazio)') = f.fonte) AS depois FROM f""",
    "rate_summary": f"SELECT {UNKNOWN} AS fonte, count(*) AS total, count(*) FILTER ({BOX}) AS parte, printf('%.1f%%', count(*) FILTER ({BOX}) * 100.0::DOUBLE / greatest(count(*), 1)) AS taxa FROM terreiros_all_sources_v2 GROUP BY 1",
    "feature_geojson": f"SELECT pos, 'Feature' AS tipo, lng AS x, lat AS y, nome, (SELECT count(*) - 2 FROM (DESCRIBE terreiros_all_sources_v2))::INTEGER AS propriedades FROM terreiros_all_sources_v2 WHERE {BOX}",
    "provenance_array": f"SELECT pos, 1 AS n, {UNKNOWN} AS fonte, {OWN_ID.format(", ''")} AS id FROM terreiros_all_sources_v2",
    "histogram_map": f"SELECT (row_number() OVER (ORDER BY fonte) - 1)::INTEGER AS ordem, fonte, n FROM (SELECT coalesce(fonte, 'desconhecida') AS fonte, count(*) AS n FROM terreiros_all_sources_v2 GROUP BY 1)",
    "source_dedupe_first": f"""SELECT pos, fonte, id, nome FROM (SELECT pos, fonte, nome, {OWN_ID.format(", ''")} AS id, row_number() OVER (PARTITION BY fonte, {OWN_ID.format(", ''")} ORDER BY pos) AS n FROM terreiros_all_sources_v2) WHERE id = '' OR n = 1""",
}
