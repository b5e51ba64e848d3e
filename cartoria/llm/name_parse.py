"""Parsing the typed name of a house: what kind of house it is, who leads it, and the words that are its own."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from cartoria.llm.address_parse import plain
from cartoria.llm.lookalikes import LOOKALIKES, SUSPECT, displayed

# Words and abbreviations that say what kind of house it is.
GENERIC = set(
    """de do da dos das e o a ile ille axe ase ashe yle okan oloja egbe terreiro terrero ter terr candomble cand casa csa cs umbanda umb umbandista centro ctr
    tenda td caboclo cab unzo unz inzo nzo abassa abaca ab sociedade soc beneficente benef santo sto associacao assoc templo espirita roca""".split()
)
# Generic words long enough to be recognised with one error in them.
LONG_GENERIC = ["terreiro", "terrero", "candomble", "umbanda", "umbandista", "centro", "caboclo", "abassa", "sociedade", "beneficente", "associacao"]
# What a leader is called.
LEADERS = {"mae", "pai", "iya", "baba", "m", "p"}
# Letters that abbreviate generic words, and letters that link or lead.
ABBREVIATING = set("abcegimopstu")
MEDIAL = set("aeomp")
# Given names of leaders, each with its short forms.
GIVEN = {
    "bartolomeu": "barto", "valdomiro": "miro", "josefa": "zefa", "antonio": "tonho", "benedita": "dita biu", "isabel": "bebel", "francisco": "chico", "joaquim": "quincas",
    "conceicao": "concita", "sebastiao": "tiao", "raimunda": "mundinha", "filomena": "filo", "guilhermina": "mina", "manoel": "mane", "severina": "biu", "teresinha": "teca", "maria": "mariinha", "joao": "jota", "jose": "ze",
}
GIVEN_NAMES = {g for full, short in GIVEN.items() for g in [full, *short.split()]}
LONG_GIVEN = sorted(g for g in GIVEN_NAMES if len(g) >= 6)
VOWELS = "aeiou"
SUSPECT_LETTER = re.compile(SUSPECT)
FOLDED = str.maketrans(LOOKALIKES)
WORD = re.compile(r"[^\W_]+")
TOKENS = re.compile(r"[a-z0-9]+").findall


class House(NamedTuple):
    """The own words of a name in order of writing, initials of own words among them, and what follows them behind a comma."""

    words: tuple[str, ...]
    tail: tuple[str, ...]


def unscanned(word: str) -> str:
    """A word with the digits that stand for letters read as letters: 0 is o, 1 is l before a vowel and i elsewhere, 5 is s."""
    if word.isalpha() or word.isdigit():
        return word
    out = word.replace("0", "o").replace("5", "s").replace("3", "e").replace("4", "a")
    return "".join(("l" if out[i + 1 : i + 2] and out[i + 1] in VOWELS else "i") if c == "1" else c for i, c in enumerate(out))


def one_error(a: str, b: str) -> bool:
    """Whether two different words are one edit or one swap of neighbours apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]:
        return True
    return len(a) == len(b) and a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]


@lru_cache(maxsize=200_000)
def is_generic(word: str) -> bool:
    return word in GENERIC or len(word) >= 5 and any(one_error(word, g) for g in LONG_GENERIC)


@lru_cache(maxsize=200_000)
def is_given(word: str) -> bool:
    return word in GIVEN_NAMES or len(word) >= 6 and any(one_error(word, g) for g in LONG_GIVEN)


def own_words(tokens: list[str], known: list[str]) -> list[str]:
    """The own words of one segment that aren't ``known``.

    A single letter is the initial of an own word if it stands after an own word or a leader's name, or after a generic word that it can't
    be part of. Letters beside another letter are abbreviations; linking and leaders' letters count only at the end.
    """
    out: list[str] = []
    led = begun = False
    last = len(tokens) - 1
    for i, w in enumerate(tokens):
        if len(w) == 1:
            beside = i and len(tokens[i - 1]) == 1 or i < last and len(tokens[i + 1]) == 1
            if not beside and not (w in MEDIAL and i < last) and (begun or 0 < i < last and w not in ABBREVIATING):
                out.append(w)
        elif w in LEADERS:
            led = True
        elif is_given(w) and (led or w in GIVEN_NAMES):
            led, begun = False, True
        elif not is_generic(w):
            begun = True
            if w not in known and w not in out:
                out.append(w)
    return out


def latin(word: re.Match) -> str:
    """A word with look-alike letters of other scripts read as Latin ones; '' for a word that is of another script."""
    read = word[0].translate(FOLDED)
    return read if plain(read).isascii() else ""


@lru_cache(maxsize=100_000)
def parse_name(name: str | None, town: str = "") -> House:
    """The own words of a name; none for a null or wholly generic one.

    Words of the town beside at least two others are left out. What follows a comma after two own words is the ``tail``: the place, or more own words,
    which only the towns of the corpus can tell.
    """
    text = name or ""
    if not text.isascii() and SUSPECT_LETTER.search(text):
        text = WORD.sub(latin, displayed(text))
    words: list[str] = []
    tail: list[str] = []
    for part in plain(text).replace("'", "").split(","):
        tokens = [unscanned(w) for w in TOKENS(part)]
        if len(words) > 1:
            tail += tokens if own_words(tokens, words) else []
        else:
            words += own_words(tokens, words)
    if sum(len(w) > 1 for w in words) > 1:  # a letter that may abbreviate a generic word is no third name
        words = [w for w in words if len(w) > 1 or w not in ABBREVIATING]
    if town and len(words) > 2:
        place = town.split()
        rest = [w for w in words if w not in place]
        words = rest if len(rest) > 1 else words
    return House(tuple(words), tuple(tail))
