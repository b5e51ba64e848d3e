"""A small generic rule set for names of places, used by the classification queries.

The rules are data: a registry brings its own. They are stated in the order in which they are tried.
"""

from __future__ import annotations

from cartoria.operators.classify import RuleSet

# Terms that mark a name as belonging to a house, whatever else is in it.
PROTECTIVE = [
    "terreiro", "candomblé", "candomble", "umbanda", "ilê", "ile ax", "ilé", "axé", "abassá", "unzó", "inzo", "egbe", "ẹgbẹ́",
    "tenda", "caboclo", "casa de santo", "mãe ", "pai ", "babá ", "iyá ",
]
# Ordered labelled patterns over the lower-cased name.
LABELLED = [
    ("Hospedagem", r"hotel|pousada|hostel"),
    ("Saúde", r"cl[ií]nica|hospital|farm[aá]cia|posto de sa[uú]de"),
    ("Ensino", r"escola|col[eé]gio|creche|faculdade"),
    ("Comércio", r"mercad|loja|padaria|restaurante|(?:^| )bar(?: |$)"),
    ("Serviço público", r"prefeitura|c[aâ]mara|secretaria"),
    ("Templo de outra religião", r"igreja|par[oó]quia|assembleia"),
    ("Entidade", r"sociedade|associa"),
    ("Abreviado", r"^(?:[a-z]\.\s*){2,}"),
]
#: Kept as an example of a rule that doesn't compile: the loader reports it and leaves it out.
BROKEN = ("Incompleto", r"oficina|(borracharia")
BLOCKING = ["mercad", "mercadinho", "hotel", "pousada", "escola", "cl[", "benef", "sociedade", "centro", "casa"]
KEEP = ["ilê", "axé", "unzó", "abassá", "casa de ervas"]
PLACES = ["vila tadirá", "noxaso", "barra do tagbende", "porto ndexare", "risula", "nova tayola"]

RULES = RuleSet(protective=PROTECTIVE, labelled=LABELLED, blocking=BLOCKING, places=PLACES)
