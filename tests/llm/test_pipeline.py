from collections import Counter

import corpus_pipeline as P
from conftest import words_of

from lodestack.llm import langid


def test_stages_like_plain_versions(spark, data):
    """Each stage on its own input, against plain Python; the last against the documents that reach it."""
    import test_jaccard_join
    import test_line_dedup

    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.train(docs)
    steps = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        out = P.materialize(stage(spark, steps[-1], data), f"t{k}")
        assert k == 4 or out.columns == docs.columns
        steps.append(out)
    rows = [[tuple(r) for r in s.collect()] for s in steps]
    key = lambda rs: sorted(rs, key=repr)
    least = langid.least_score(docs, model)
    assert key(rows[1]) == key(r for r in rows[0] if model.predict(r[1])[1] >= least and model.predict(r[1])[0] != "und")
    dropped = test_line_dedup.plain(rows[1])
    assert key((r[0], r[1]) for r in rows[2]) == key((d, t) for d, t, _, _ in dropped) and all(r[4] == len(r[1]) for r in rows[2])
    classes = test_jaccard_join.plain(rows[2], 5, 80)
    stay = {d for d, _, c in classes if d == c}
    assert key(rows[3]) == key(r for r in rows[2] if r[0] in stay)
    times = Counter(r[0] for r in rows[4])
    assert set(times) <= stay and set(times.values()) <= {1, 2}
    total = sum(len(words_of(r[1])) for r in rows[3])
    assert abs(sum(len(words_of(r[1])) for r in rows[4]) - 1.5 * total) < 0.1 * total
    pieces = steps[5].collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == times and len({p.sequence_id for p in pieces}) == len(pieces)


def test_run(spark, data):
    assert P.run(spark, data).count() > 0


EXTRA = "doc_id long, text string, lang string, source string, n_chars int, lost_doc int, lost_k1 int, lost_first int, gone_doc int, row int, copies int, n_lines string, k1 string, bin int"


def through(spark, df):
    for k, (_, stage) in enumerate(P.STAGES):
        out = P.materialize(stage(spark, df, ""), f"e{k}")
        assert k == 4 or out.columns == df.columns and out.dtypes == df.dtypes
        df = out
    return df


def test_repeated_and_null_ids_and_clashing_names(spark, edge_rows):
    rows = [(*r[:4], 7, 1, 2, 3, 4, 5, 6, "nine", "x", 8) for r in edge_rows]
    rows += [(None, "eins zwei drei vier fünf sechs " * 3, "de", "s1", 1, 1, 1, 1, 1, 1, 1, "a", "b", 2)] * 4 + [(9001, "one two three four five six seven " * 3, "en", "s2", 1, 1, 1, 1, 1, 1, 1, "a", "b", 2)] * 3
    pieces = through(spark, spark.createDataFrame(rows, EXTRA).repartition(3)).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert {p.doc_id for p in pieces} >= {None, 9001}
    assert Counter(p.doc_id for p in pieces if p.start == 0)[9001] <= 6


def test_no_documents(spark):
    assert through(spark, spark.createDataFrame([], EXTRA)).count() == 0
