import pytest
from pyspark.sql import functions as F

from lodestack.functions import strings as S


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [("Rockwell Automation", "rockwell-automation"), ("Straße & Größe", "strasse-gr-sse"), ("--", "unknown"), ("", "unknown"), (None, "unknown"), ("ﬁne ﬂow", "fine-flow"), ("P&ID", "p-id")],
)
def test_slug(spark, value, expected):
    assert one(spark, S.slug, value) == expected


def test_fold_agrees_with_python_on_all_letters(spark):
    import re

    letters = [chr(c) for c in range(0x20, 0x10000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    rows = spark.createDataFrame([(c,) for c in letters], "x string").select("x", S.fold(F.col("x")).alias("y")).collect()
    cut = lambda s: re.sub("[^a-z0-9]", "", s)
    assert [(r.x, cut(r.y)) for r in rows if cut(r.y) != cut(r.x.casefold())] == []


def test_strip_takes_no_break_spaces(spark):
    assert one(spark, S.strip, " \t a b \n") == "a b"


@pytest.mark.parametrize("low, high", [("original", "Rev B"), ("Rev B", "Rev C"), ("Rev C", "1"), ("2", "v10.3"), ("12", "current")])
def test_revisions_in_order(spark, low, high):
    a, b = (one(spark, S.revision_key, v) for v in (low, high))
    assert tuple(a) < tuple(b)


def test_no_revision(spark):
    assert one(spark, S.revision_key, "  ") is None and one(spark, S.revision_key, "??") is None
