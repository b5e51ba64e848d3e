"""Text semantics: whitespace, case, substring and pattern tests, rule lists."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, SparkSession, functions as F


def stripped(text: Column) -> Column:
    """Without white space (Unicode) at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapsed(text: Column) -> Column:
    """Stripped, with every run of white space inside made one space."""
    return F.regexp_replace(stripped(text), r"(?U)\s+", " ")


def folded(text: Column) -> Column:
    """Lower case for caseless comparison; sharp s becomes ss. Accents stay."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def irredundant(terms: list[str]) -> list[str]:
    """Lower-cased distinct terms without those that contain another one: any-match over them is the same."""
    distinct = sorted({t.lower() for t in terms if t}, key=lambda t: (len(t), t))
    kept: list[str] = []
    for term in distinct:
        if not any(k in term for k in kept):
            kept.append(term)
    return kept


def contains_any(text: Column, terms: list[str]) -> Column:
    """Whether the lower-cased text has one of the terms in it; one alternation over the irredundant terms. Null gives null."""
    kept = irredundant(terms)
    if not kept:
        return F.when(text.isNotNull(), F.lit(False))
    return F.lower(text).rlike("|".join(re.sub(r"([^\w\s])", r"\\\1", t) for t in kept))


def first_contained(text: Column, terms: list[str]) -> Column:
    """The first term in list order that the lower-cased text contains; null if none. Order and doubles of the list hold."""
    lowered = F.lower(text)
    return F.get(F.filter(F.array(*[F.lit(t.lower()) for t in terms]), lambda t: F.contains(lowered, t)), F.lit(0))


def valid_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Rules whose pattern compiles in the JVM, in order, and the others, which are reported by a warning."""
    good, bad = [], []
    compile_java = spark.sparkContext._jvm.java.util.regex.Pattern.compile
    for label, pattern in rules:
        try:
            compile_java("(?U)" + pattern)
            good.append((label, pattern))
        except Exception:  # noqa: BLE001 - the JVM's exception type depends on the gateway
            bad.append((label, pattern))
    if bad:
        warnings.warn(f"rules left out, their patterns don't compile: {[label for label, _ in bad]}", stacklevel=2)
    return good, bad


def first_label(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the first rule whose pattern is found in the lower-cased text; null if none. Any number of rules: they are tried a hundred to an expression."""
    lowered = F.lower(text)
    parts = []
    for at in range(0, len(rules), 100):
        chain = None
        for label, pattern in rules[at : at + 100]:
            found = lowered.rlike("(?U)" + pattern)
            chain = F.when(found, F.lit(label)) if chain is None else chain.when(found, F.lit(label))
        parts.append(chain)
    return F.coalesce(*parts, F.lit(None).cast("string"))


def html_escaped(text: Column) -> Column:
    """The five characters with a meaning in HTML as entities."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text
