"""Parsing a typed postal address into its components.

Works on text alone, one address at a time, and never guesses across addresses.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

# Kinds of street and their written forms (without accents, lower case).
KINDS = {
    "rua": "rua r",
    "avenida": "avenida av aven avda",
    "travessa": "travessa trv trav tv tr",
    "ladeira": "ladeira lad ld",
    "estrada": "estrada estr est",
    "beco": "beco bco bc",
    "caminho": "caminho cam cmo",
    "alameda": "alameda alam al",
    "praca": "praca pca pc pr",
    "largo": "largo lgo lg",
    "rodovia": "rodovia rod",
    "loteamento": "loteamento loteam lot",
    "viela": "viela vla",
    "passagem": "passagem psg",
    "servidao": "servidao serv",
    "via": "via",
}
# Kinds of neighbourhood, which begin its name.
DISTRICTS = {
    "jardim": "jardim jd",
    "parque": "parque pq pque",
    "conjunto": "conjunto cj conj",
    "vila": "vila vl v",
    "nova": "nova",
    "alto": "alto a",
    "baixa": "baixa bx",
    "ilha": "ilha",
    "engenho": "engenho eng engo",
    "centro": "centro",
}
# Titles in street names, which come and go between spellings.
TITLES = {
    "professor": "professor prof", "padre": "padre pe", "santa": "santa sta", "general": "general gal gen",
    "coronel": "coronel cel", "engenheiro": "engenheiro eng engo", "doutor": "doutor dr", "dona": "dona d", "frei": "frei fr", "sao": "sao",
}
KIND_OF = {w: k for k, ws in KINDS.items() for w in ws.split()}
DISTRICT_OF = {w: k for k, ws in DISTRICTS.items() for w in ws.split()}
TITLE_OF = {w: k for k, ws in TITLES.items() for w in ws.split()}
# Remarks and unit hints.
REMARK = re.compile(
    r"\b(?:(?:ao lado|em frente|proxim[oa]|perto|atras|depois|antes|defronte) (?:d[aeo]s?|a[os]?) [a-z]+(?: [a-z]+)?|final de linha|fim de linha|subindo a escada|descendo a escada|fundos|frente|terreo|sobrado|subsolo"
    r"|(?:casa|apto|ap|apartamento|sala|loja|bloco|bl|quadra|qd|lote|lt|andar|cobertura)(?: (?:[a-z]|\d{1,4}[a-z]?))?)\b(?=\s*(?:$|[,;()\-]))"
)
POSTCODE = re.compile(r"\b(?:cep[\s:.]*)?(\d{5})[\s.-]?(\d{3})\b")
NO_NUMBER = re.compile(r"\b(?:s\s*/\s*n[o]?|s\s*\.?\s*n[o]?|sem numero)\b\.?(?=\s*(?:$|[,;()\-/]|cep))")
NUMBER = re.compile(r"(?:(?<=[\s,;(#])|^)(?:(?:numero|num|no|n)[\s.:]*|#\s*)?(\d{1,5})(?:-?([a-z]))?(?=$|[\s,;()\-]|\.(?!\s*d[aeo]s?\b))(?!\s+d[aeo]s?\s+[a-z])")
MARKS = re.compile("[\u0300-\u036f]")
UNKNOWN = {"", "-", "?", "n/i", "a confirmar", "sem endereco", "nao informado", "nao consta"}


class Address(NamedTuple):
    """What an address says; '' where it says nothing. ``street`` has no title, ``number`` no leading zeros and its letter.

    ``district`` may be the town where an address names a single place after its street; only the record's own town tells.
    """

    kind: str = ""
    title: str = ""
    street: str = ""
    number: str = ""
    district: str = ""
    town: str = ""
    postcode: str = ""


def plain(text: str | None) -> str:
    """Lower case without accents, styled forms or doubled spaces."""
    text = text or ""
    if not text.isascii():
        text = MARKS.sub("", unicodedata.normalize("NFKD", text.replace("º", "o").replace("°", "o").replace("–", "-")))
    return " ".join(text.lower().split())


@lru_cache(maxsize=200_000)
def district_key(text: str) -> str:
    """A neighbourhood's name with its kind spelled out and without linking words: 'bx. do x' -> 'baixa x'."""
    words = re.findall(r"[a-z0-9]+", plain(text))
    if words and words[0] in DISTRICT_OF and len(words) > 1:
        words[0] = DISTRICT_OF[words[0]]
    return " ".join([w for w in words[:1]] + [w for w in words[1:] if w not in ("do", "da", "de", "dos", "das")])


@lru_cache(maxsize=100_000)
def town_key(text: str) -> str:
    return " ".join(re.findall(r"[a-z0-9]+", plain(text)))


def is_district(words: list[str]) -> bool:
    """Whether a run of words begins like a neighbourhood; short forms that also begin streets need a linking word."""
    if len(words) < 2 or words[0] not in DISTRICT_OF:
        return False
    return words[0] not in ("a", "eng", "engo") or words[1] in ("do", "da", "de")


def split_street(words: list[str]) -> tuple[str, str, str]:
    """Kind, title and name of a street from its words."""
    kind = title = ""
    if len(words) > 1 and words[0] in KIND_OF:
        kind, words = KIND_OF[words[0]], words[1:]
    if len(words) > 1 and words[0] in TITLE_OF and len(words[0]) > 1:
        title, words = TITLE_OF[words[0]], words[1:]
    return kind, title, " ".join(w for w in words if w not in ("do", "da", "de", "dos", "das"))


def parse(text: str | None) -> Address:
    """The components of an address; all '' for a null, an empty one or a remark for unknown."""
    s = plain(text)
    if s in UNKNOWN or not re.search("[a-z]", s):
        return Address()
    postcode = ""
    if found := POSTCODE.search(s):
        postcode, s = found[1] + found[2], s[: found.start()] + " , " + s[found.end() :]
    s = re.sub(r"\bbrasil\b", " , ", s)
    town = ""
    # an enclosure is the street where it holds a number or a kind of street, else a remark
    street_part = ""
    if found := re.search(r"\(([^()]*)\)?", s):
        inside = found[1].strip()
        head = re.match(r"[a-z]+", inside)
        if not REMARK.fullmatch(inside) and (head and head[0] in KIND_OF or re.search(r"\d|\bs\s*/\s*n", inside) or len(inside.split()) in (2, 3)) and not REMARK.match(inside):
            street_part = inside
        s = s[: found.start()] + " ; " + s[found.end() :]
    if found := re.match(r"([a-z' ]+?)\s*/\s*ba\b[\s,-]*", s):
        town, s = found[1].strip(), s[found.end() :]
    s = REMARK.sub(" , ", s)
    street_part = REMARK.sub(" , ", street_part)
    number = ""
    tail = []

    def take_number(part: str) -> str:
        nonlocal number
        part = NO_NUMBER.sub(" ; ", " " + part + " ")
        if found := NUMBER.search(part):
            number = str(int(found[1])) + (found[2] or "")
            part = part[: found.start()] + " ; " + part[found.end() :]
        return part

    if street_part:
        street_part = take_number(street_part)
    else:
        s = take_number(s)
    segments = [w for seg in re.split(r"[,;/]|\s-\s|\s-|-\s|\.\s*$", s) if (w := re.findall(r"[a-z0-9']+", seg))]
    street: list[str] = []
    district: list[str] = []
    if street_part:
        street = next((w for seg in re.split("[,;]", street_part) if (w := re.findall(r"[a-z0-9']+", seg))), [])
    for words in segments:
        if words[-1] == "ba" and len(words) > 1 and not town:
            words = words[:-1]
            town = " ".join(words)
            continue
        if words == ["ba"]:
            if tail and not town:
                town = " ".join(tail.pop())
            continue
        if not street and words[0] in KIND_OF and len(words) > 1 and not is_district(words):
            street = words
        elif not district and is_district(words):
            inner = next((i for i, w in enumerate(words[2:], 2) if w in KIND_OF), 0) if not street else 0
            if inner:
                district, street = words[:inner], words[inner:]
            else:
                district = words
        else:
            tail.append(words)
    if not street and tail:
        street = tail.pop(0)
    if not district and tail and (town or len(tail) > 1):
        district = tail.pop(0)
    if not town and tail:
        if district:
            town = " ".join(tail[0])
        else:
            district = tail[0]
    for i in range(2, len(street) - 1):  # a neighbourhood that follows without a separator
        if is_district(street[i:]) and (street[i] != "v" or i > 2):
            street, district = street[:i], district or street[i:]
            break
    kind, title, name = split_street(street)
    return Address(kind, title, name, number, district_key(" ".join(district)), town_key(town), postcode)
