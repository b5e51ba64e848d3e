"""Shared parts of the linking operators: tolerant comparison of words and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


#: Each word of a name must find one at least so similar.
WEAKEST = 0.6


def close_words(a: Column, b: Column) -> Column:
    """Whether two words are equal but for one edit, or two in long words, or two letters that changed places."""
    distance = F.levenshtein(a, b, 2)
    short = F.least(F.length(a), F.length(b))
    swapped = F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))
    return (a == b) | ((distance == 1) & (short >= 4)) | ((distance == 2) & (short >= 4) & ((short >= 7) | swapped))


def word_similarity(a: Column, b: Column, distance: Column | None = None) -> Column:
    """1 minus the edits per letter of the longer word; two letters that changed places count as one edit. ``distance`` is their Levenshtein distance, if a column has it."""
    distance = F.levenshtein(a, b) if distance is None else distance
    edits = F.when(distance != 2, distance).when((F.length(a) == F.length(b)) & (F.sort_array(F.split(a, "")) == F.sort_array(F.split(b, ""))), 1).otherwise(2)
    return 1 - edits / F.greatest(F.length(a), F.length(b), F.lit(1))


def best_matches(x: Column, y: Column) -> Column:
    """For each word of ``x`` the similarity of the closest word of ``y``."""
    return F.transform(x, lambda a: F.array_max(F.transform(y, lambda b: word_similarity(a, b))))


def least_mean(x: Column, y: Column, weakest: float) -> Column:
    """The smaller of both directions' mean best similarities; 0 where a word has no match of at least ``weakest``."""
    mean = lambda s: F.aggregate(s, F.lit(0.0), lambda t, v: t + v) / F.size(s)
    there, back = best_matches(x, y), best_matches(y, x)
    return F.when((F.array_min(there) >= weakest) & (F.array_min(back) >= weakest), F.least(mean(there), mean(back))).otherwise(F.lit(0.0))


def joined_mean(more: Column, fewer: Column, weakest: float) -> Column:
    """The best ``least_mean`` over every way to run two words of ``more`` together, in either order; only ways whose joined word has a match are followed."""
    places = F.sequence(F.lit(0), F.size(more) - 1)
    ways = F.flatten(F.transform(places, lambda i: F.transform(F.filter(places, lambda j: j != i), lambda j: F.struct(F.concat(F.get(more, i), F.get(more, j)).alias("joined"), i.alias("i"), j.alias("j")))))
    near = lambda a, b: F.when(F.abs(F.length(a) - F.length(b)) <= (1 - weakest) * F.greatest(F.length(a), F.length(b)), word_similarity(a, b) >= weakest).otherwise(F.lit(False))
    matched = F.filter(ways, lambda w: F.exists(fewer, lambda y: near(w["joined"], y)))
    rest = lambda w: F.concat(F.array(w["joined"]), F.transform(F.filter(places, lambda k: (k != w["i"]) & (k != w["j"])), lambda k: F.get(more, k)))
    return F.coalesce(F.array_max(F.transform(matched, lambda w: least_mean(rest(w), fewer, weakest))), F.lit(0.0))


def two_by_two(a: Column, b: Column, weakest: float = WEAKEST) -> Column:
    """``monge_elkan`` of two names of two words each, paired one to one; in plain expressions, which Spark compiles. Equal words are a pair."""
    x, y = F.split(a, " "), F.split(b, " ")
    x1, x2, y1, y2 = F.get(x, F.lit(0)), F.get(x, F.lit(1)), F.get(y, F.lit(0)), F.get(y, F.lit(1))
    paired = lambda s, t: F.when(F.least(s, t) >= weakest, (s + t) / 2).otherwise(F.lit(0.0))
    rest = lambda u, v: paired(F.lit(1.0), word_similarity(u, v))
    both = F.greatest(paired(word_similarity(x1, y1), word_similarity(x2, y2)), paired(word_similarity(x1, y2), word_similarity(x2, y1)))
    return F.when(x1 == y1, rest(x2, y2)).when(x2 == y2, rest(x1, y1)).when(x1 == y2, rest(x2, y1)).when(x2 == y1, rest(x1, y2)).otherwise(both)


def one_by_few(a: Column, b: Column, weakest: float = WEAKEST) -> Column:
    """``monge_elkan`` of a name of one word and one of one or two, in plain expressions: the two words run together in the better order."""
    joined = lambda t: F.replace(t, F.lit(" "))
    turned = lambda t: F.concat(F.substring_index(t, " ", -1), F.substring_index(t, " ", 1))
    plain = word_similarity(joined(a), joined(b))
    s = F.when(F.instr(a, " ") > 0, F.greatest(plain, word_similarity(turned(a), b))).when(F.instr(b, " ") > 0, F.greatest(plain, word_similarity(a, turned(b)))).otherwise(plain)
    return F.when(s >= weakest, s).otherwise(F.lit(0.0))


#: Which measure a pair of names takes: that of any names, of one word and few, of two and two words.
ANY, FEW, TWO = 0, 1, 2


def shape(n: Column, m: Column) -> Column:
    """The kind of measure for names of ``n`` and ``m`` words."""
    return F.when((n == 2) & (m == 2), TWO).when((n <= 2) & (m <= 2), FEW).otherwise(ANY).cast("byte")


def monge_elkan(a: Column, b: Column, weakest: float = WEAKEST) -> Column:
    """Symmetric Monge-Elkan similarity of two names of any number of words: the smaller of both directions' means.

    Every word must find one that is at least ``weakest`` alike. Where one name has a word more, the best way to run two of its words
    together counts; names of other numbers of words are 0 alike.
    """
    x, y = F.split(a, " "), F.split(b, " ")
    n, m = F.size(x), F.size(y)
    return F.when(n == m, least_mean(x, y, weakest)).when(n == m + 1, joined_mean(x, y, weakest)).when(m == n + 1, joined_mean(y, x, weakest)).otherwise(F.lit(0.0))


def measured(pairs: DataFrame, least: float, weakest: float = WEAKEST) -> DataFrame:
    """``pairs`` of two names ``w`` and ``v`` with their ``monge_elkan`` as ``s``, those of at least ``least``; equal names are 1 alike.

    What a measure uses more than once is a column of its own, as Spark computes an expression again wherever it stands. Two names of two words need the
    distances across only where no word stands in both at its place. The filter comes after a generator, else Spark would compute all of it in the join before.
    """
    a, b = F.col("w"), F.col("v")
    spaces = lambda t: F.length(t) - F.length(F.replace(t, F.lit(" ")))
    parts = [f(t, " ", n).alias(c) for f, t, n, c in ((F.substring_index, a, 1, "_x1"), (F.substring_index, a, -1, "_x2"), (F.substring_index, b, 1, "_y1"), (F.substring_index, b, -1, "_y2"))]
    split = pairs.select("*", *parts, F.when(a == b, None).otherwise(shape(spaces(a) + 1, spaces(b) + 1)).alias("_shape"))
    two = F.col("_shape") == TWO
    distance = lambda x, y: F.levenshtein(f"_x{x}", f"_y{y}").alias(f"_d{x}{y}")
    alike = lambda x, y: word_similarity(F.col(f"_x{x}"), F.col(f"_y{y}"), F.col(f"_d{x}{y}")).alias(f"_s{x}{y}")
    here = split.select("*", *[F.when(two, distance(k, k)).alias(f"_d{k}{k}") for k in (1, 2)])
    apart = two & (F.col("_d11") > 0) & (F.col("_d22") > 0)
    across = here.select("*", *[F.when(apart, distance(x, y)).alias(f"_d{x}{y}") for x, y in ((1, 2), (2, 1))])
    words = across.select("*", *[alike(x, y) for x in (1, 2) for y in (1, 2)])
    ways = words.select("*", *[F.when(F.least(f"_s{x}", f"_s{y}") >= weakest, (F.col(f"_s{x}") + F.col(f"_s{y}")) / 2).otherwise(0.0).alias(f"_w{x}") for x, y in (("11", "22"), ("12", "21"))])
    crossed = (F.col("_d12") == 0) | (F.col("_d21") == 0)  # an equal word is a pair, wherever it stands
    paired = F.when(~apart, F.col("_w11")).when(crossed, F.col("_w12")).otherwise(F.greatest("_w11", "_w12"))
    measure = F.when(F.col("_shape").isNull(), 1.0).when(two, paired).when(F.col("_shape") == FEW, one_by_few(a, b, weakest)).otherwise(monge_elkan(a, b, weakest))
    scored = ways.select(*pairs.columns, measure.alias("_m"))
    return scored.select(*pairs.columns, F.explode(F.array("_m")).alias("s")).filter(F.col("s") >= least)
