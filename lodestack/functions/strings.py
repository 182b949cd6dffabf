"""String functions whose results are byte-exact keys elsewhere. Columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters whose full case folding differs from lower case in [a-z0-9].
FOLDS = {"ß": "ss", "ẞ": "ss", "ŉ": "n", "ſ": "s", "ǰ": "j", "ẖ": "h", "ẗ": "t", "ẘ": "w", "ẙ": "y", "ẚ": "a", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}

# Words that carry no meaning of their own, and negations.
STOPWORDS = ("a", "an", "and", "at", "be", "for", "from", "in", "into", "is", "of", "on", "or", "the", "to", "with")
NEGATIONS = ("no", "not", "never", "without", "avoid")

_ONE = {k: v for k, v in FOLDS.items() if len(v) == 1}
_MANY = {k: v for k, v in FOLDS.items() if len(v) > 1}


def fold(x: Column) -> Column:
    """Case folding, exact for what is later cut to ASCII letters and digits."""
    out = F.translate(F.lower(x), "".join(_ONE), "".join(_ONE.values()))
    for k, v in _MANY.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def strip(x: Column) -> Column:
    """Without white space of any script at its ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def collapse(x: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def slug(x: Column) -> Column:
    """Folded, runs of other characters than a-z and 0-9 as one hyphen, ``unknown`` if nothing is left."""
    return slug_of_folded(fold(x))


def slug_of_folded(x: Column) -> Column:
    """``slug`` of what ``fold`` gave."""
    out = F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(out == "", F.lit("unknown")).otherwise(out)


def classifier_text(x: Column) -> Column:
    """Folded, with single spaces for everything but a-z and 0-9."""
    return F.trim(F.regexp_replace(fold(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))


def tokens(x: Column) -> Column:
    """Distinct meaningful tokens, sorted."""
    found = F.regexp_extract_all(fold(F.coalesce(x, F.lit(""))), F.lit("([a-z0-9]+)"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(*STOPWORDS))))


def digest(x: Column, length: int = 64) -> Column:
    return F.substring(F.sha2(x, 256), 1, length)


def bare(revision: Column) -> Column:
    """What revisions are compared by: folded, without white space at their ends."""
    return strip(fold(revision))


def is_original(revision: Column) -> Column:
    return bare_is_original(bare(revision))


def bare_is_original(own: Column) -> Column:
    """``is_original`` of what ``bare`` gave."""
    # Names of a first edition.
    return own.isin("original", "initial", "first-edition", "first edition", "rev 0", "rev0", "revision 0", "r0", "a", "rev a", "revision a")


def revision_key(revision: Column) -> Column:
    """(tier, number) that orders revisions: original, single letters, numbers, current; null if there is none."""
    return bare_key(bare(revision))


def bare_key(own: Column) -> Column:
    """``revision_key`` of what ``bare`` gave; it is named many times here, so a column of its own saves most of the work."""
    number = F.regexp_extract(own, r"(\d+)", 1)
    letter = F.regexp_extract(own, r"\b([a-z])\b", 1)
    key = lambda tier, n: F.struct(F.lit(tier).alias("tier"), n.cast("long").alias("n"))
    return (
        F.when(own.isNull() | (own == ""), F.lit(None))
        .when(bare_is_original(own), key(0, F.lit(0)))
        .when(own.isin("current", "latest"), key(3, F.lit(9999)))
        .when(number != "", key(2, F.expr("0") + F.when(number != "", number.cast("decimal(18,0)"))))
        .when(letter != "", key(1, F.ascii(letter) - 96))
    )
