"""Section types by keyword: all lists of all contexts in one automaton, so a text is read once.

An automaton (Aho-Corasick) tells every keyword that is somewhere in a text. Each keyword has a rank in
each context, its place in that context's lists; the type of the smallest rank wins.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestack.functions import vocabulary as V

LISTS = {"manual": V.MANUAL_KEYWORDS, "operational": V.OPERATIONAL_KEYWORDS, "drawing": V.DRAWING_KEYWORDS, "bulletin": V.BULLETIN_KEYWORDS}
CONTEXTS = tuple(V.CONTEXT_ORDERS)


@lru_cache(maxsize=1)
def automaton() -> tuple[ahocorasick.Automaton, tuple[tuple[str, ...], ...]]:
    """The automaton, whose values are a keyword's ranks by context; and each context's types by rank."""
    ranks: dict[str, list[int]] = {}
    kinds = []
    for c, name in enumerate(CONTEXTS):
        listed = [(kind, word) for which in V.CONTEXT_ORDERS[name] for kind, words in LISTS[which] for word in words]
        kinds.append(tuple(kind for kind, _ in listed))
        for rank, (_, word) in enumerate(listed):
            own = ranks.setdefault(word, [len(listed)] * len(CONTEXTS))
            own[c] = min(own[c], rank)
    made = ahocorasick.Automaton()
    for word, own in ranks.items():
        made.add_word(word, tuple(own))
    made.make_automaton()
    return made, tuple(kinds)


def first_type(text: str, context: int) -> str | None:
    """The type of the context's first keyword that is in the text."""
    found, kinds = automaton()
    best = min((ranks[context] for _, ranks in found.iter(text)), default=len(kinds[context]))
    return kinds[context][best] if best < len(kinds[context]) else None


def _first_type_of(context: pd.Series, title: pd.Series, above: pd.Series, usual: pd.Series, inside: pd.Series) -> pd.Series:
    known: dict[tuple[str, int], str | None] = {}  # titles repeat

    def told(text: str, c: int) -> str | None:
        if (text, c) not in known:
            known[text, c] = first_type(text, c)
        return known[text, c]

    out = []
    for name, t, a, u, i in zip(context, title, above, usual, inside, strict=True):
        c = CONTEXTS.index(name)
        kind = told(t, c) if t else None
        kind = kind or (told(a, c) if a else None) or u or (first_type(i, c) if i else None)
        out.append(kind)
    return pd.Series(out, dtype="object")


def section_type(context: Column, title: Column, above: Column, usual: Column, inside: Column) -> Column:
    """What the title tells, else the titles above it, else the usual type, else the content; null texts are not looked at."""
    return F.pandas_udf(_first_type_of, "string")(context, title, above, usual, inside)
