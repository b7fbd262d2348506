"""Risk vocabularies and lexicons."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple


class Term(NamedTuple):
    keyword: str
    category: str
    severity: float


# Results depend on these words, categories, severities and on their order
# (the order breaks ties between categories of equal severity).
_DEFAULT = {
    "water_damage": {
        "mold": 0.9, "mould": 0.9, "toxic mold": 1.0, "black mold": 1.0, "seepage": 0.7,
        "leak": 0.5, "leaking": 0.5, "water damage": 0.6, "flooding": 0.6, "moisture": 0.4,
        "damp": 0.4, "dampness": 0.4, "humidity": 0.3, "condensation": 0.3,
    },
    "litigation": {
        "attorney": 0.9, "lawyer": 0.9, "lawsuit": 1.0, "litigation": 1.0, "legal": 0.7,
        "sue": 0.8, "suing": 0.8, "court": 0.8, "demand letter": 0.9, "representation": 0.6,
    },
    "structural": {
        "structural": 0.7, "foundation": 0.8, "collapse": 0.9, "settling": 0.6, "crack": 0.5,
        "cracking": 0.5, "sinkhole": 1.0,
    },
    "bodily_injury": {
        "injury": 0.8, "injured": 0.8, "medical": 0.6, "hospital": 0.7, "death": 1.0,
        "fatality": 1.0,
    },
    "fraud": {
        "suspicious": 0.7, "inconsistent": 0.6, "contradictory": 0.7, "staged": 0.9,
        "prior damage": 0.8, "pre-existing": 0.7,
    },
    "catastrophe": {
        "hurricane": 0.5, "tornado": 0.5, "earthquake": 0.5, "wildfire": 0.5, "hail": 0.4,
    },
}

# The shorter list, in its own order, with the severities of the full list.
_SHORT = (
    "mold", "black mold", "toxic mold", "seepage", "leak", "water damage", "flooding",
    "moisture", "damp", "attorney", "lawyer", "lawsuit", "litigation", "legal", "sue",
    "structural", "foundation", "collapse", "crack",
)

DEFAULT_TERMS: tuple[Term, ...] = tuple(
    Term(word, category, severity)
    for category, words in _DEFAULT.items()
    for word, severity in words.items()
)
SHORT_TERMS: tuple[Term, ...] = tuple(
    next(term for term in DEFAULT_TERMS if term.keyword == word) for word in _SHORT
)

# Substrings behind the pattern-based flags.
PATTERN_FLAGS = {
    "has_water_mold_risk": ("mold", "seepage", "moisture", "damp"),
    "has_litigation_risk": ("attorney", "lawyer", "lawsuit", "litigation", "legal counsel"),
    "has_structural_risk": ("structural", "foundation", "collapse"),
}
PATTERN_CATEGORIES = (
    ("litigation", ("attorney", "lawsuit")),
    ("water_damage", ("mold", "seepage")),
    ("structural", ("structural", "foundation")),
)
PATTERN_HIGH_RISK = ("mold", "attorney", "lawsuit", "structural", "seepage")

# The seven entities a classified claim reports, in output order. The words that
# stand for each entity are this library's own rules.
ENTITY_WORDS = {
    "mold_damage": ("mold", "mould", "toxic mold", "black mold"),
    "water_damage": ("water damage", "flooding", "seepage", "leak", "leaking", "moisture", "damp"),
    "litigation_risk": ("lawsuit", "litigation", "court", "sue", "suing", "demand letter"),
    "structural_damage": ("structural", "foundation", "collapse", "crack", "cracking", "sinkhole"),
    "bodily_injury": ("injury", "injured", "medical", "hospital", "death", "fatality"),
    "fraud_indicator": ("suspicious", "inconsistent", "contradictory", "staged", "prior damage"),
    "attorney_involvement": ("attorney", "lawyer", "legal counsel", "representation"),
}
NEGATIVE_WORDS = (
    "lawsuit", "sue", "fatality", "suspicious", "staged", "toxic", "collapse", "feared",
    "inconsistent", "injured", "soaked", "stolen",
)
POSITIVE_WORDS = ("satisfied", "complete", "finished", "repaired", "resolved")


def extend(
    custom: Mapping[str, tuple[str, float]], base: tuple[Term, ...] = DEFAULT_TERMS
) -> tuple[Term, ...]:
    """Merge ``{keyword: (category, severity)}`` over ``base``.

    An overridden keyword keeps its position; new ones follow in the given order.
    """
    merged = {term.keyword: (term.category, term.severity) for term in base}
    merged.update(custom)
    return tuple(Term(word, category, float(severity)) for word, (category, severity) in merged.items())
