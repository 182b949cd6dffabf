import random
import re

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, size string, k1 string, part string, n_words string"


def sentence(rng, n):
    return " ".join(rng.choice("the of pump valve seal turn open close flow Ärger größe é niño red blue".split()) + rng.choice(["", "", "", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Documents with nulls, empty and long texts, copies, near copies, shared passages and lines, ties and repeated rows."""
    rng = random.Random(11)
    base = [sentence(rng, 60) for _ in range(6)]
    passage = sentence(rng, 20)
    texts = [None, "", " \n\t ", "one", "One two", "!!! 123 ???", "a\nb\n\nc"]
    texts += base + base[:3] + [base[0].upper()] + [b + " extra" for b in base[:3]] + [f"{sentence(rng, 15)} {passage} {sentence(rng, 9)}" for _ in range(4)]
    texts += ["  This line is in many documents.  \nrare %d" % k for k in range(4)] + ["THIS LINE is in many documents.\n" * 2] + [sentence(rng, 3000)]
    texts += ["wher " * 40, "wher " * 55, "wher. " * 20 + sentence(rng, 5)]
    rows = [(k * 3 + 1, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), 7, "x", "x", "x", "x", "x") for k, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, base[0], "en", None, None, None, None, None, None, None), (500, None, None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text, lower=False):
    if lower:
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
