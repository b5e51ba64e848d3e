"""Cross-source entity match by distance or name, as a chain of pair rules, clusters and survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartoria.functions.lineage import cut
from cartoria.operators.components import components
from cartoria.operators.skew import blocked_join, sieve_of, sifted
from cartoria.operators.spatial import near_classes, valid_points


def normal_name(name: Column) -> Column:
    """Lower case, without accents on the letters of Portuguese, words separated by one space."""
    plain = F.translate(F.lower(name), "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def name_heads(named: DataFrame) -> DataFrame:
    """``n, h1, h2``: for each name its row of smallest pos and the one of smallest pos of another source, null where there is none.

    ``named`` has ``n, pos, fonte``; rows of no known source count as one source.
    """
    row = F.struct("pos", "fonte")
    first = named.groupBy("n").agg(F.min(row).alias("h1"))
    other = named.join(first, "n").filter(~F.col("fonte").eqNullSafe(F.col("h1.fonte"))).groupBy("n").agg(F.min(row).alias("h2"))
    return first.join(other, "n", "left")


def same_name_links(named: DataFrame, heads: DataFrame) -> DataFrame:
    """``p, q``: each row of a name that several sources carry with the smallest row of another source; fewer links than rows."""
    head = F.when(F.col("fonte").eqNullSafe(F.col("h1.fonte")), F.col("h2.pos")).otherwise(F.col("h1.pos"))
    return named.join(heads.filter(F.col("h2").isNotNull()), "n").select(F.col("pos").alias("p"), head.alias("q"))


def contained_names(names: DataFrame, letters: int = 6, long: int = 14) -> DataFrame:
    """``s, l``: distinct names of at least ``letters`` characters and the other names that hold them as they are.

    A name seeks the names that hold one of its runs of ``long`` characters, or of ``letters`` if it is shorter than that, which every name that holds it must: the run that
    is rarest by counts of hash buckets. A sieve drops the runs that nobody seeks before anything is shuffled; then the whole name is looked for.
    """
    named = cut(names.select("n").distinct().filter(F.length("n") >= letters))
    runs = lambda size: F.transform(F.sequence(F.lit(1), F.length("n") - size + 1), lambda i: F.xxhash64(F.substr("n", i, F.lit(size))))
    at_least = F.length("n") >= long
    grams = lambda which: named.select(F.xxhash64("n").alias("k"), F.length("n").alias("m"), F.explode(which).alias("gram"))
    own = grams(F.when(at_least, runs(long)).otherwise(runs(letters)))
    bucket = F.pmod("gram", F.lit(1 << 16)).cast("int")
    counts = own.groupBy(bucket.alias("b")).agg(F.count("*").alias("c"))  # at most 65,536 rows
    rarest = own.withColumn("b", bucket).join(F.broadcast(counts), "b").groupBy("k", "m").agg(F.min(F.struct("c", "gram")).alias("g"))
    sought = cut(rarest.select(F.col("k").alias("ks"), F.col("m").alias("ms"), F.col("g.gram").alias("gram")))
    offered = sifted(grams(F.when(at_least, F.concat(runs(letters), runs(long))).otherwise(runs(letters))), "gram", sieve_of(sought, "gram"))
    met = blocked_join(sought, offered, ["gram"], 1_000).filter(F.col("m") > F.col("ms")).select("k", "ks").distinct()
    names_by = lambda k, n: named.select(F.xxhash64("n").alias(k), F.col("n").alias(n))
    return met.join(names_by("k", "l"), "k").join(names_by("ks", "s"), "ks").filter(F.contains("l", "s")).select("s", "l")


def crossing_links(members: DataFrame, heads: DataFrame, met: DataFrame) -> DataFrame:
    """``p, q``: links between rows of different sources of which one's class meets the other's, enough for the components of all such pairs.

    ``members`` has ``n`` (the class)``, pos, fonte``, ``met`` the pairs ``s, l`` of classes. The heads of both classes are linked. The rows of a class that several
    sources carry are linked by that already (``same_name_links``); those of a class of one source are each linked to one row of another class.
    """
    side = lambda name, x: heads.select(F.col("n").alias(name), F.explode(F.array_compact(F.array("h1", "h2"))).alias(x), F.col("h2").isNull().alias(f"{x}_one"))
    ends = met.join(side("s", "x"), "s").join(side("l", "y"), "l").filter(~F.col("x.fonte").eqNullSafe(F.col("y.fonte")))
    ends = cut(ends.select("s", "l", F.col("x.pos").alias("p"), F.col("y.pos").alias("q"), "x_one", "y_one"))
    one = ends.filter("x_one").select(F.col("s").alias("n"), "q").unionByName(ends.filter("y_one").select(F.col("l").alias("n"), F.col("p").alias("q"))).groupBy("n").agg(F.min("q").alias("q"))
    return ends.select("p", "q").unionByName(members.join(one, "n").select(F.col("pos").alias("p"), "q")).distinct()


def entity_members(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two written tables ``n, pos, fonte``: the rows by their point and by their normalised name. Rows of unknown source are of one source."""
    rows = df.select("pos", F.nullif(F.col("fonte"), F.lit("")).alias("fonte"), normal_name(F.col("nome")).alias("name"), "lat", "lng")
    placed = cut(valid_points(rows).select(F.struct("lat", "lng").alias("n"), "pos", "fonte"))
    return placed, cut(rows.filter(F.col("name") != "").select(F.col("name").alias("n"), "pos", "fonte"))


def near_points(placed: DataFrame, metres: float, max_abs_lat: float) -> DataFrame:
    """``s, l``: the pairs of different points at most so far apart."""
    points = placed.select("n.lat", "n.lng").distinct()
    pairs = near_classes(points, metres, max_abs_lat=max_abs_lat)
    return pairs.select(F.struct(F.col("lat_a").alias("lat"), F.col("lng_a").alias("lng")).alias("s"), F.struct(F.col("lat_b").alias("lat"), F.col("lng_b").alias("lng")).alias("l"))


def match_pairs(df: DataFrame, metres: float = 50.0, max_abs_lat: float = 18.5) -> DataFrame:
    """``a, b, regra``: what ties rows of different sources, in the compact form of classes, each by its row of smallest ``pos``.

    'ponto' and 'nome': ``b`` is a row of the class of ``a``, which several sources carry. 'distancia' and 'inclusao': two classes of which some rows are of different
    sources, their points at most so far apart, or one's name of more than five characters within the other's.
    """
    placed, named = entity_members(df)

    def members(rows: DataFrame, heads: DataFrame, rule: str) -> DataFrame:
        shared = heads.filter(F.col("h2").isNotNull()).select("n", F.col("h1.pos").alias("a"))
        return rows.join(shared, "n").filter(F.col("pos") != F.col("a")).select("a", F.col("pos").alias("b"), F.lit(rule).alias("regra"))

    def classes(heads: DataFrame, met: DataFrame, rule: str) -> DataFrame:
        side = lambda n, x: heads.select(F.col("n").alias(n), F.col("h1").alias(x), F.col("h2").isNull().alias(f"{x}1"))
        both = met.join(side("s", "x"), "s").join(side("l", "y"), "l")
        crossing = ~(F.col("x1") & F.col("y1") & F.col("x.fonte").eqNullSafe(F.col("y.fonte")))
        return both.filter(crossing).select(F.least("x.pos", "y.pos").alias("a"), F.greatest("x.pos", "y.pos").alias("b"), F.lit(rule).alias("regra"))

    points, names = cut(name_heads(placed)), cut(name_heads(named))
    tied = members(placed, points, "ponto").unionByName(members(named, names, "nome"))
    return tied.unionByName(classes(points, near_points(placed, metres, max_abs_lat), "distancia")).unionByName(classes(names, contained_names(named), "inclusao"))


def linked_pairs(df: DataFrame, metres: float = 50.0, max_abs_lat: float = 18.5) -> DataFrame:
    """``a, b, regra``: links between rows of different sources whose components are those of all pairs that the three rules tie.

    A row is linked to the smallest row of another source at its point and of its name, and classes of points or names are linked by few rows, so no
    class is expanded into its pairs. The first rule that applies is kept.
    """
    placed, named = entity_members(df)
    points, names = cut(name_heads(placed)), cut(name_heads(named))
    near = same_name_links(placed, points).unionByName(crossing_links(placed, points, near_points(placed, metres, max_abs_lat))).withColumn("r", F.lit(1))
    links = near.unionByName(same_name_links(named, names).withColumn("r", F.lit(2))).unionByName(crossing_links(named, names, contained_names(named)).withColumn("r", F.lit(3)))
    pairs = links.groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(F.min("r").alias("r"))
    return pairs.select("a", "b", F.when(F.col("r") == 1, "distancia").when(F.col("r") == 2, "nome").otherwise("inclusao").alias("regra"))


def clusters(pairs: DataFrame) -> DataFrame:
    """``pos, grupo``: connected components by smallest label; rows without a pair are not in it."""
    return components(pairs, "a", "b").select(F.col("node").alias("pos"), F.col("root").alias("grupo"))


def merged_entities(df: DataFrame, labels: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each cluster or single row: the densest row's fields, gaps filled from the next densest.

    Density is the number of filled fields; ties go to the smaller ``pos``. Each field is its own maximum, so no group is ever collected.
    """
    filled = [F.nullif(F.col(f).cast("string"), F.lit("")).isNotNull() for f in fields]
    density = sum((c.cast("int") for c in filled[1:]), filled[0].cast("int"))
    grouped = df.join(labels, "pos", "left").withColumn("grupo", F.coalesce("grupo", "pos")).withColumn("_d", F.struct(density.alias("d"), (-F.col("pos")).alias("p")))
    picks = [F.max_by(F.col(f), F.when(c, F.col("_d"))).alias(f) for f, c in zip(fields, filled)]
    return grouped.groupBy("grupo").agg(F.count("*").alias("registros"), F.count_distinct("fonte").alias("fontes_distintas"), *picks)
