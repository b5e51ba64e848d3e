"""Problem 10: sentence boundaries across languages and scripts.

Segmentation rules in cascading tables. A text is first cut at blank lines. In each paragraph every run of final
marks, with the closing quotes, brackets and emoji after it, is a candidate. At a candidate the rules of the
cascade are tried in order and the first whose patterns match before and after the position decides: break or no break.
A cascade begins with what holds everywhere, goes on with the tables of the paragraph's languages and of the domain, then with initials and ends with
the defaults. Labels are missing or wrong and texts mix languages, so a paragraph's languages are told by its script and,
in Latin script, by its function words; the label counts beside these.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartoria.sources.tables import table

BREAK, JOIN = True, False
# Marks that can end a sentence, pairs that enclose, emoji parts.
MARKS = r"[.!?…‥。．｡！？؟۔।॥።]"
CLOSING = r"[”’\"»›」』）)\]】〉》]"
QUOTE_END = r"[”\"»›」』]"
BRACKET_END = r"[）)\]】]"
PAIRS = ["“”", "«»", "‹›", "「」", "『』", "()", "（）", "[]", "【】"]
EMOJI = r"(?:\p{Extended_Pictographic}[️‍\U0001F3FB-\U0001F3FF\p{Extended_Pictographic}\U0001F9B0-\U0001F9B3]*)"
CANDIDATE = regex.compile(rf"({MARKS}+)((?:{CLOSING}|\s+[»›]|\s*{EMOJI})*)")
BLANK_LINE = regex.compile(r"(?:\r\n|\r(?!\n)|\n)(?:[^\S\r\n]*(?:\r\n|\r(?!\n)|\n))+")
SPANS = regex.compile("|".join(f"{regex.escape(a)}[^{regex.escape(a + b)}]*{regex.escape(b)}" for a, b in PAIRS))
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}]"
THAI_GAP = regex.compile(r"(?<=[฀-๿])\s+(?=[฀-๿])")



class Rule(NamedTuple):
    """Break or no break where ``before`` matches up to the position and ``after`` from it.

    ``words`` stand for a pattern before: abbreviations, the last word before a dot, looked up and not tried one by one. ``where`` the candidate stands: "" anywhere,
    "led" at the end of an enclosure that opens the sentence, "inner" at the end of one that opens later.
    """

    act: bool
    before: str = ""
    after: str = ""
    where: str = ""
    words: frozenset[str] = frozenset()


EVERYWHERE = [
    Rule(JOIN, r"", rf"\s*[,;:،؛，；：、)\]}}»”」』）]|{MARKS}"),  # the sentence goes on after a comma, a colon or another mark
    Rule(JOIN, r"\d[.．]", r"\d"),  # decimals, dates, versions
    Rule(JOIN, r"[\p{L}\d]\.", r"[\p{Ll}ºª\d]"),  # addresses of the web, n.º, e.g, a.m
    Rule(JOIN, r"(?<![\p{L}\p{M}])\p{Lu}\.", r"\p{Lu}\."),  # acronyms
    Rule(JOIN, BRACKET_END, r"\s*\S", "inner"),  # a bracket within a running sentence
    Rule(JOIN, QUOTE_END, r"\s*\p{Ll}"),  # a quotation within a running sentence
    Rule(JOIN, r"[」』”»]", rf"\s*{UNSPACED}", "led"),  # a quotation that leads a sentence of an unspaced script
    Rule(JOIN, r"[」』]", r"と"),
    Rule(JOIN, r"(?<![\p{L}\p{M}])[Pp]\.", r"\s*e[jx]\."),  # p. ex., p. ej.
    Rule(JOIN, r"(?:\.{2,}|[…‥]+)", rf"\s*(?:\p{{Ll}}|{UNSPACED})"),  # an ellipsis that the sentence continues after
]


def listed(words: str) -> frozenset[str]:
    """Abbreviations in their written form and with a capital."""
    return frozenset(v for w in words.split() for v in (w, w[0].upper() + w[1:]))


def titles(words: str) -> Rule:
    """Abbreviations that always stand before something."""
    return Rule(JOIN, after=r"\s", words=listed(words))


def numbered(words: str) -> Rule:
    """Abbreviations only before a number."""
    return Rule(JOIN, after=r"\s*\d", words=listed(words))


def open_ended(words: str) -> Rule:
    """Abbreviations that may end a sentence: they do before a capital."""
    return Rule(JOIN, after=r"\s+[\p{Ll}\d(]", words=listed(words))


# Words that open a sentence and are no names, and small words that go before a name.
OPENING = "|".join("The This That These Those Then There They He She It We You I In On At After When But And If As For His Her Their Our My Its Not No Yes So O A Os As Um Uma Ele Ela Eles Elas Em No Na Quando Mas E Se El La Los Las Un Una Ella En Cuando Pero Y Le Les Il Elle On Nous Vous Et Mais Quand".split())
LEADING = "by with of to from for and de do da dos das e em com por para del y con le la du et par avec".split()
# Common abbreviations of each language.
LANGUAGES: dict[str, list[Rule]] = {
    "pt": [
        titles("sr sra srta dr dra drs prof profa Pe Fr Ir Eng Arq Cel Gal Gen Cap Maj Sto Sta Exmo Exma av Tv Trav Lad Estr Pça Rod Cj Jd Bx Pq Vl Ed Apto Lt Qd cf pp pág fls séc tel aprox obs ref"),
        numbered("pag fl fig art cap vol n no núm cel min máx v p"),
        open_ended("etc ex a.C d.C Ltda Cia S.A"),
        Rule(JOIN, r"(?<![\p{L}\p{M}])[RDS]\.", rf"\s+(?!(?:{OPENING})(?![\p{{L}}\p{{M}}]))\p{{Lu}}"),  # rua, dona, são
    ],
    "es": [titles("sr sra srta dr dra prof D.ª Dña ud uds vd vds avda av pza pág tel p.ej ej Sto Sta Gral"), numbered("núm n.º cap fig vol p"), open_ended("etc a.C d.C EE.UU")],
    "en": [
        titles("mr mrs ms dr prof Rev Hon St Sr Jr Capt Col Gen Lt Sgt vs cf approx e.g i.e"), numbered("fig figs no nos vol p pp ch sec eq"), open_ended("etc a.m p.m U.S U.K Inc Ltd Co al Ave Blvd"),
    ],
    "fr": [titles("MM Mme Mmes Mlle Dr Pr Mgr Ste bd tél env"), numbered("ch fig n vol p"), open_ended("etc ex J.-C")],
    "yo": [titles("Dkt Ọgb Alh Ọ̀jọ̀g Olóy"), open_ended("abbl bbl")],
    "hi": [titles("डॉ डा श्री प्रो पं कु सं रु"), open_ended("इत्यादि")],
    "ar": [titles("د أ م ص ج ت هـ"), open_ended("الخ إلخ")],
    "ja": [], "zh": [], "th": [],
}
# Abbreviations in names of houses and addresses, which stand in texts of every language; single letters only before a word that goes on in lower case.
DOMAIN = [titles("Csa Cs Cand Ctr Umb Soc Benef Td Terr Unz Ab"), Rule(JOIN, r"(?<![\p{L}\p{M}])\p{Lu}\.", r"\s+\p{Ll}")]
# Function words that tell a language written in Latin letters.
TELLING: dict[str, set[str]] = {
    "pt": set("o a os as um uma de do da dos das em no na nos nas que não com para por é foi são ao à se mais mas como quando já também ele ela seu sua".split()),
    "es": set("el la los las un una de del en que no con para por es fue son al se más pero como cuando ya también él ella su y lo".split()),
    "en": set("the a an of in on at to and is was are were that it he she they we you with for from by not this but his her their our has had have".split()),
    "fr": set("le la les un une des de du en dans que ne pas avec pour par est était sont au aux se plus mais comme quand il elle et ce son sa nous vous".split()),
    "yo": set("ní ti ó wọ́n àwọn náà fún sí kò jẹ́ tí nínú láti pẹ̀lú yìí rẹ̀ wa ilé ṣe gbogbo".split()),
}
SCRIPTS = [*LANGUAGES["hi"], *LANGUAGES["ar"]]  # of scripts of their own, so they hold beside any table
INITIALS = [
    Rule(BREAK, r"(?<![\p{L}\p{M}\d.])\p{Lu}\.", rf"\s+(?:{OPENING})(?![\p{{L}}\p{{M}}])"),  # plan B. Then
    Rule(JOIN, rf"(?<![\p{{L}}\p{{M}}])(?:{'|'.join(LEADING)})\s\p{{Lu}}\.", r"\s+\p{L}"),  # by J. Smith
    Rule(BREAK, r"(?<![\p{L}\p{M}])\p{Ll}[\p{Ll}\p{M}]*\s\p{Lu}\.", r"\s+\p{Lu}"),  # vitamin C. Results
    Rule(JOIN, r"(?<![\p{L}\p{M}\d.])\p{Lu}\.", r"\s+\p{L}"),  # John F. Smith
]
DEFAULTS = [
    Rule(BREAK, r"", r"\s|\Z"),
    Rule(BREAK, rf"[!?。．｡！？؟۔।॥።]{CLOSING}*", r""),
    Rule(BREAK, r"", r"\p{Lu}|[¿¡“«「『(（]|" + UNSPACED),
    Rule(BREAK, EMOJI, r""),
]
LATIN = regex.compile(r"\p{Latin}")
WORDS = regex.compile(r"[\p{L}\p{M}]+")
#: The last word before a dot, dots within it included.
ABBREVIATED = regex.compile(r"(?r)(?<![\p{L}\p{M}])[\p{L}\p{M}][\p{L}\p{M}.ºª\-]*(?=\.)")


TOLD = {w: [name for name in TELLING if w in TELLING[name]] for w in set().union(*TELLING.values())}
#: What any language's table looks up before a dot; other candidates need no language.
ASKED = frozenset(w for rules in LANGUAGES.values() for r in rules for w in r.words)


class Table(NamedTuple):
    """Consecutive rules of one action, tried at once: of rules that say the same it doesn't matter which matches."""

    act: bool
    anywhere: regex.Pattern | None
    placed: dict[str, regex.Pattern]
    words: dict[str, regex.Pattern]


@lru_cache(maxsize=None)
def cascade(languages: tuple[str, ...], initial: bool = False) -> list[Table]:
    """The compiled tables for languages in their order, those about initials only where an ``initial`` stands before the position."""
    own = [r for name in languages for r in LANGUAGES[name]]
    out = []
    for act, run in groupby([*EVERYWHERE, *own, *SCRIPTS, *DOMAIN, *(INITIALS if initial else []), *DEFAULTS], key=lambda r: r.act):
        rules = list(run)
        pattern = lambda where: "|".join((f"(?<={r.before})" if r.before else "") + f"(?={r.after})" for r in rules if r.where == where and not r.words)
        words: dict[str, list[str]] = {}
        for r in rules:
            for w in r.words:
                words.setdefault(w, []).append(r.after)
        compiled = lambda p: regex.compile(p) if p else None
        out.append(Table(act, compiled(pattern("")), {w: regex.compile(p) for w in ("led", "inner") if (p := pattern(w))}, {w: regex.compile("|".join(after)) for w, after in words.items()}))
    return out


def languages_of(paragraph: str, label: str) -> tuple[str, ...]:
    """The languages of a paragraph in Latin script, most function words first: those with a quarter of the most or more, and the label.

    None for other scripts; the label, or all, where no function word is known.
    """
    if not paragraph.isascii() and not LATIN.search(paragraph):
        return ()
    hits = dict.fromkeys(TELLING, 0)
    for word in WORDS.findall(paragraph.lower()):
        for name in TOLD.get(word, ()):
            hits[name] += 1
    most = max(hits.values())
    if not most:
        return (label,) if label in TELLING else tuple(TELLING)
    return tuple(sorted((name for name, n in hits.items() if n * 4 >= most or name == label), key=lambda name: (-hits[name], name != label)))


def enclosures(paragraph: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the outermost enclosures, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for found in SPANS.finditer(paragraph):
        if not ends or found.start() >= ends[-1]:
            starts.append(found.start())
            ends.append(found.end())
    return starts, ends


def abbreviated(paragraph: str, mark: int) -> str | None:
    """The word before the single dot at ``mark``, dots within it included; None if there is none."""
    found = ABBREVIATED.search(paragraph, max(0, mark - 20), mark + 1)
    return found[0] if found and found.end() == mark else None


def decided(paragraph: str, at: int, word: str | None, where: str, tables: list[Table]) -> bool:
    """Whether the sentence ends at a position, ``word`` being what stands before its only dot."""
    for act, anywhere, placed, words in tables:
        if anywhere is not None and anywhere.match(paragraph, at) or where in placed and placed[where].match(paragraph, at) or word in words and words[word].match(paragraph, at):
            return act
    return JOIN


def boundaries(paragraph: str, label: str) -> list[int]:
    """The positions in a paragraph after which a new sentence begins."""
    plain, own, cuts, start = cascade(()), (), [], 0
    starts, ends = enclosures(paragraph)
    for found in CANDIDATE.finditer(paragraph):
        mark, at = found.span()
        if at == len(paragraph):
            break
        where = ""
        if starts:
            k = bisect_right(starts, mark) - 1
            if k >= 0 and ends[k] > mark:
                if at < ends[k]:
                    continue  # within a quotation or bracket
                where = "inner" if paragraph[start : starts[k]].strip() else "led"
        word, tables = None, plain
        if at == mark + 1 and paragraph[mark] == ".":
            word = abbreviated(paragraph, mark)
            single = word is not None and len(word) == 1
            if single or word in ASKED:
                own = own or languages_of(paragraph, label)
                tables = cascade(own, single)
        if decided(paragraph, at, word, where, tables):
            cuts.append(at)
            start = at
    gaps = [g.start() for g in THAI_GAP.finditer(paragraph)]
    return sorted({*cuts, *gaps}) if gaps else cuts


def sentences(text: str, lang: str | None = None) -> list[tuple[int, int]]:
    """The sentences of a text as (first code point, end); none for a blank text."""
    code = (lang or "").strip().lower()[:2]
    out, begin = [], 0
    for stop, following in [*((m.start(), m.end()) for m in BLANK_LINE.finditer(text)), (len(text), len(text))]:
        paragraph = text[begin:stop]
        left = 0
        for right in [*boundaries(paragraph, code), len(paragraph)]:
            piece = paragraph[left:right]
            inner = piece.strip()
            if inner:
                first = begin + left + len(piece) - len(piece.lstrip())
                out.append((first, first + len(inner)))
            left = right
        begin = following
    return out


def split_sentences(df: DataFrame, id: str, text: str, lang: str) -> DataFrame:
    """``id, inicio, fim``: one row for each sentence of each text, whatever its length.

    Null, empty and blank texts have no row. A null or unknown language gets the common cascade.
    """
    kind = df.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, first, end = [], [], []
            for i, (t, code) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for a, b in sentences(t, code) if t else ():
                    rows.append(i)
                    first.append(a)
                    end.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(first, pa.int64()), pa.array(end, pa.int64())], [id, "inicio", "fim"])

    return df.select(id, F.col(text).cast("string"), F.col(lang).cast("string")).mapInArrow(run, f"`{id}` {kind}, inicio bigint, fim bigint")


def p10_found(spark: SparkSession, directory: str) -> DataFrame:
    """The sentences of every document."""
    return split_sentences(table(spark, directory, "documents"), "doc_id", "text", "lang")


QUERIES = {"p10_found": p10_found}
SQL: dict[str, str] = {}
