"""The string functions again, written for DuckDB: text of expressions for the comparison queries."""

from __future__ import annotations

from lodestack.functions.strings import FOLDS, STOPWORDS


def fold(x: str) -> str:
    out = f"lower({x})"
    for k, v in FOLDS.items():
        out = f"replace({out}, '{k}', '{v}')"
    return out


def slug(x: str) -> str:
    core = f"regexp_replace(regexp_replace({fold(f'coalesce({x}, chr(32))')}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"coalesce(nullif({core}, ''), 'unknown')"


def classifier_text(x: str) -> str:
    return f"trim(regexp_replace({fold(f'coalesce({x}, chr(32))')}, '[^a-z0-9]+', ' ', 'g'))"


def tokens(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    return f"list_sort(list_distinct(list_filter(regexp_extract_all({fold(f'coalesce({x}, chr(32))')}, '[a-z0-9]+'), lambda t: len(t) > 1 AND t NOT IN ({stop}))))"


def pick(values: tuple[str, ...], index: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][({index}) % {len(values)} + 1]"
