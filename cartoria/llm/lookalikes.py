"""Problem 3: text that looks right but is stored with other characters.

Script-aware repair. A text first loses what displays like something else whatever its neighbours:
wide and styled letters, invisible characters, unusual spaces, accents stored apart. Then each token's
dominant script is determined. In a token that mixes scripts the letters of other scripts that look like ones of the dominant script, or, if all of its
letters have a Latin double, like Latin ones, are substituted if the result is a word of the corpus. A token wholly of such letters is
one that mixes scripts with the text around it; it is treated alike, so real words of another script stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartoria.functions.lineage import cut
from cartoria.operators.skew import small
from cartoria.sources.tables import table

# Letters of other scripts, or rare Latin ones, that display like a basic Latin letter.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l", "к": "k", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ԍ": "G", "Ӏ": "I",
    # Greek
    "α": "a", "ο": "o", "υ": "u", "ν": "v", "ι": "i", "ρ": "p", "κ": "k", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j", "ω": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "Օ": "O", "Տ": "S", "Լ": "L",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭹ": "Y", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏼ": "B",
    # Coptic
    "Ⲁ": "A", "Ⲃ": "B", "Ⲉ": "E", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "ⲭ": "x",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # Latin letters outside Portuguese and Yoruba
    "ɑ": "a", "ı": "i", "ɡ": "g", "ȷ": "j", "ʀ": "R", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ᴄ": "c", "ꜱ": "s",
}
# Compatibility forms that only differ in width or style.
STYLED = ("<wide>", "<narrow>", "<font>", "<circle>")
INVISIBLE = {0xAD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, 0x3164, 0xFFA0, 0xFEFF}
#: What can need repair: anything but ASCII, plain letters of Latin-1 and Yoruba, typographic marks.
SUSPECT = r"[^\x00-\x7F¡-¬®-ÿẸẹỌọṢṣŃńǸǹ‐-―‘-‟†-…]"


TOKEN = re.compile(r"(?:[^\W_]|[\u0300-\u036f])+|(?:(?![\u0300-\u036f])[\W_])+")


@lru_cache(maxsize=10_000)
def script(letter: str) -> str:
    """The first word of a letter's Unicode name, which is its script for the scripts that matter here."""
    return unicodedata.name(letter, "?").split(" ")[0]


#: For each script of the table, its letters by the Latin ones that look like them.
OTHER_WAY = {name: {latin: other for other, latin in LOOKALIKES.items() if script(other) == name} for name in {script(c) for c in LOOKALIKES} - {"LATIN"}}



# Scripts whose letters joiners shape, so that a joiner between them is part of the word.
JOINED = {"ARABIC", "SYRIAC", "MONGOLIAN", "NKO", "DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "KHMER", "MYANMAR", "TIBETAN"}


@lru_cache(maxsize=10_000)
def plain_form(c: str) -> str:
    """The character that ``c`` displays like by width or style alone, or '' if it doesn't display, or ``c``."""
    n = ord(c)
    if n < 128:
        return c
    kind = unicodedata.category(c)
    if kind == "Zs":
        return " "
    if kind == "Cf" or n in INVISIBLE or 0xFE00 <= n <= 0xFE0F:
        return ""
    shape = unicodedata.decomposition(c)
    if shape.startswith("<compat>") and (0x2160 <= n <= 0x217F or 0xFB00 <= n <= 0xFB06):
        return unicodedata.normalize("NFKC", c)
    if shape.startswith(STYLED):
        folded = unicodedata.normalize("NFKC", c)
        if folded.isascii() or script(folded[0]) == "LATIN":
            return folded
    return c


def shaping(text: str, i: int) -> bool:
    """Whether the joiner or selector at ``i`` shapes what stands before it: a letter of a joined script or a pictograph."""
    if i == 0 or ord(text[i]) not in (0x200C, 0x200D) and not 0xFE00 <= ord(text[i]) <= 0xFE0F:
        return False
    before = text[i - 1]
    return script(before) in JOINED or unicodedata.category(before) == "So" or 0xFE00 <= ord(before) <= 0xFE0F and i > 1 and unicodedata.category(text[i - 2]) == "So"


def displayed(text: str) -> str:
    """The text by what displays alone: composed, without styles, widths, unusual spaces and invisible characters."""
    return unicodedata.normalize("NFC", "".join(c if shaping(text, i) else plain_form(c) for i, c in enumerate(text)))


def dominant_script(token: str) -> tuple[str, int]:
    """The script of most letters of a token, Latin at a tie, and how many scripts it mixes."""
    counts = Counter(script(c) for c in token if c.isalpha())
    if not counts:
        return "", 0
    return max(counts, key=lambda s: (counts[s], s == "LATIN", s)), len(counts)


def substituted(token: str) -> str:
    """A token with its look-alikes of the dominant script in place of other letters, or of Latin if all letters have a Latin double; else as it is.

    Latin letters outside Portuguese and Yoruba that look like basic ones count as another script.
    """
    if token.isascii():
        return token
    dominant, mixed = dominant_script(token)
    folded = unicodedata.normalize("NFC", "".join(LOOKALIKES.get(c, c) for c in token))
    if all(script(c) == "LATIN" for c in folded if c.isalpha()):
        return folded
    if mixed > 1 and dominant in OTHER_WAY:
        toward = OTHER_WAY[dominant]
        back = "".join(toward.get(c, c) for c in token)
        if dominant_script(back)[1] == 1:
            return back
    return token


def tokens(text: str) -> Iterator[str]:
    """The words of a text, marks stored apart among them, and what is between them."""
    return (t[0] for t in TOKEN.finditer(text))


def repair(text: str) -> tuple[str, list[str], bool]:
    """The text by what displays, the words that substitutions would make, and whether anything has changed so far."""
    out = displayed(text)
    wanted = [] if out.isascii() else [s.lower() for t in tokens(out) if (s := substituted(t)) != t]
    return out, wanted, out != text


def substitute(text: str, words: set[str]) -> str:
    """``text`` with the substitutions of its tokens whose results are in ``words``."""
    return "".join(s if (s := substituted(t)) != t and s.lower() in words else t for t in tokens(text))


def repaired_texts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows whose ``text`` is stored otherwise than it displays: ``keys`` and ``repaired``.

    Null, empty and ASCII texts never appear. Only rows with a suspect character reach Python, once; what they give is written. The corpus
    vocabulary is every word of every text; it is joined only with the few words asked for.
    """
    out_schema = df.select(*keys).schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", repaired string, wanted array<string>, sure boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [repair(t) for t in batch["_t"]]
            batch = batch.drop(columns="_t")
            batch["repaired"], batch["wanted"], batch["sure"] = [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]
            yield batch[batch["sure"] | (batch["wanted"].str.len() > 0)]

    suspects = cut(df.filter(F.col(text).rlike(SUSPECT)).select(*keys, F.col(text).alias("_t")).mapInPandas(run, out_schema))
    wanted = suspects.select(F.explode("wanted").alias("word")).distinct()
    corpus = df.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}\p{M}\p{N}]+")).alias("word")).filter(F.col("word") != "")
    known = corpus.join(small(wanted), "word", "left_semi").distinct().withColumn("_k", F.lit(True))
    asking = suspects.filter(F.size("wanted") > 0).select(*keys, "repaired", "sure", F.explode("wanted").alias("word"))
    asked = asking.join(known, "word", "left").groupBy(*keys, "repaired", "sure").agg(F.collect_set(F.when(F.col("_k"), F.col("word"))).alias("words"))
    answered = asked.filter(F.col("sure") | (F.size("words") > 0)).select(*keys, substituting("repaired", "words").alias("repaired"))
    return suspects.filter(F.size("wanted") == 0).select(*keys, "repaired").unionByName(answered)


@F.pandas_udf(T.StringType())
def substituting(texts: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([substitute(t, set(w)) for t, w in zip(texts, words)])


def both_tables(spark: SparkSession, directory: str) -> DataFrame:
    places = table(spark, directory, "terreiros_all_sources_v2").select(F.lit("terreiros_all_sources_v2").alias("tabela"), "pos", F.col("nome").alias("texto"))
    return places.unionByName(table(spark, directory, "revisao_humana_nacao_v2").select(F.lit("revisao_humana_nacao_v2").alias("tabela"), "pos", F.col("nacao_original").alias("texto")))


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """The rows whose text is stored otherwise than it displays."""
    return p3_repaired(spark, directory).select("tabela", "pos")


def p3_repaired(spark: SparkSession, directory: str) -> DataFrame:
    """The same rows with their text in the form the others have."""
    return repaired_texts(both_tables(spark, directory), ["tabela", "pos"], "texto").withColumnRenamed("repaired", "corrigido")


QUERIES = {"p3_found": p3_found, "p3_repaired": p3_repaired}
SQL: dict[str, str] = {}
