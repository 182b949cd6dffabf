"""Queries that score results."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestack.operators import evaluation as O
from lodestack.plans.registry import query
from lodestack.plans.views import table


@query("""WITH scored AS (SELECT lang, (doc_id * 37 % 1000)::DOUBLE / 1000 AS c FROM documents)
  SELECT lang, count(*) AS records, min(c) AS least, max(c) AS greatest, round(avg(c), 3) AS mean, count(*) FILTER (WHERE c < 0.5) AS low, count(*) FILTER (WHERE c >= 0.5 AND c < 0.8) AS medium, count(*) FILTER (WHERE c >= 0.8) AS high FROM scored GROUP BY lang""")
def confidence_dist(spark, sf_dir):
    scored = table(spark, sf_dir, "documents").select("lang", ((F.col("doc_id") * 37 % 1000).cast("double") / 1000).alias("c"))
    return O.confidence_distribution(scored, "lang", "c")


@query("""WITH truth AS (SELECT source, doc_id, quality = 1 AS expected, n_chars > 1500 AS actual FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
  counted AS (SELECT source, count(*) FILTER (WHERE expected AND actual) AS hits, count(*) FILTER (WHERE expected) AS expected, count(*) FILTER (WHERE actual) AS actual FROM truth GROUP BY source)
  SELECT source, hits, expected, actual, round(CASE WHEN expected = 0 AND actual = 0 THEN 100.0::DOUBLE WHEN hits = 0 THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * hits / (expected + actual) END, 6) AS f1,
    round(CASE WHEN expected = 0 THEN CASE WHEN actual = 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END ELSE greatest(0.0::DOUBLE, 1 - abs(expected - actual)::DOUBLE / greatest(expected, 1)) * 100 END, 6) AS count_accuracy FROM counted""")
def eval_extraction(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    truth = docs.join(labels, "doc_id").where("quality IS NOT NULL").select("source", (F.col("quality") == 1).alias("e"), (F.col("n_chars") > 1500).alias("a"))
    counted = truth.groupBy("source").agg(F.count(F.when(F.col("e") & F.col("a"), 1)).alias("hits"), F.count(F.when(F.col("e"), 1)).alias("expected"), F.count(F.when(F.col("a"), 1)).alias("actual"))
    e, a = F.col("expected"), F.col("actual")
    return counted.withColumn("f1", F.round(O.f1(F.col("hits"), e, a), 6)).withColumn("count_accuracy", F.round(O.count_accuracy(e, a), 6))


@query("""WITH e AS (SELECT quality, doc_id, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS place FROM labels), a AS (SELECT toxic, doc_id, row_number() OVER (PARTITION BY toxic ORDER BY doc_id) AS place FROM labels)
  SELECT e.quality, e.place, e.doc_id AS expected, a.doc_id AS actual FROM e LEFT JOIN a ON e.quality = a.toxic AND e.place = a.place""")
def eval_zip(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    actual = labels.select(F.col("toxic").alias("quality"), "doc_id")
    return O.zip_sorted(labels, actual, "quality", "doc_id").withColumn("place", F.col("place").cast("long"))


def _eval_tables(spark, sf_dir):
    """Documents as tables of fixtures: one is expected, two that follow are found; the cells are the words."""
    d = F.col("doc_id")
    cells = F.array_distinct(F.split("text", " "))
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        F.floor(d / 40).alias("fixture"), F.when(d % 2 == 0, "expected").otherwise("actual").alias("role"), d.alias("ordinal"), (F.floor(d / 2) % 3).alias("rows"), F.lit(2).cast("long").alias("columns"),
        F.when(d % 6 == 0, F.slice(cells, 1, 1)).otherwise(cells).alias("cells"),
    )


@query("""WITH RECURSIVE shaped AS (SELECT doc_id // 40 AS fixture, doc_id % 2 = 0 AS wanted, doc_id AS ordinal, doc_id // 2 % 3 AS rows, list_distinct(string_split(text, ' ')) AS words, string_split(text, ' ')[1:1] AS opening FROM documents WHERE text IS NOT NULL),
  wants AS (SELECT fixture, ordinal, rows, CASE WHEN ordinal % 6 = 0 THEN opening ELSE words END AS cells, row_number() OVER (PARTITION BY fixture ORDER BY ordinal) AS place FROM shaped WHERE wanted),
  lists AS (SELECT w.fixture, w.place, coalesce(list(a.ordinal ORDER BY a.ordinal) FILTER (WHERE a.ordinal IS NOT NULL), []) AS fits FROM wants w
    LEFT JOIN shaped a ON NOT a.wanted AND a.fixture = w.fixture AND a.rows = w.rows AND list_has_all(CASE WHEN a.ordinal % 6 = 0 THEN a.opening ELSE a.words END, w.cells) GROUP BY w.fixture, w.place),
  greedy AS (SELECT DISTINCT fixture, 0::BIGINT AS place, []::BIGINT[] AS used FROM shaped
    UNION ALL SELECT g.fixture, l.place, CASE WHEN l.free[1] IS NULL THEN g.used ELSE list_append(g.used, l.free[1]) END FROM greedy g JOIN LATERAL (SELECT place, list_filter(fits, lambda x: NOT list_contains(g.used, x)) AS free FROM lists WHERE lists.fixture = g.fixture AND lists.place = g.place + 1) l ON true),
  done AS (SELECT fixture, max(place) AS expected, max(len(used)) AS matched FROM greedy GROUP BY fixture)
  SELECT fixture, expected, matched::BIGINT AS matched FROM done""")
def eval_parser(spark, sf_dir):
    return O.match_tables(_eval_tables(spark, sf_dir))


@query("""SELECT event_id, len(json_keys(props))::BIGINT AS expected_leaves, CASE WHEN event_id % 3 = 0 THEN (props->>'k' = '0')::BIGINT ELSE len(json_keys(props))::BIGINT END AS matched_leaves FROM events""")
def eval_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("expected"), F.when(F.col("event_id") % 3 == 0, F.lit('{"k": 0}')).otherwise(F.col("props")).alias("actual"))
    return O.json_agreement(rows, "expected", "actual").select("event_id", "expected_leaves", "matched_leaves")


@query("""WITH typed AS (SELECT lang, count(*) AS n, list_sort(list_distinct(list(source))) AS kinds FROM documents WHERE source IS NOT NULL GROUP BY lang),
  hits AS (SELECT lang, n, len(list_intersect(kinds, ['web', 'books', 'news', 'none'])) AS hit FROM typed)
  SELECT lang, round(greatest(0.0, 100.0 - abs(n - 2003) * 25.0) * 0.4::DOUBLE + round(hit::DOUBLE / 4 * 100, 2) * 0.6::DOUBLE, 2) AS fidelity FROM hits""")
def eval_structure(spark, sf_dir):
    typed = table(spark, sf_dir, "documents").where("source IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.collect_set("source").alias("kinds"))
    want = F.array(*map(F.lit, ("web", "books", "news", "none")))
    return typed.select("lang", O.structure_fidelity(F.lit(2003), F.col("n"), want, F.col("kinds")).alias("fidelity"))


@query("""WITH plain AS (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\r\\n\\x0B\\f]+', ' ', 'g')) AS whole FROM documents WHERE text IS NOT NULL)
  SELECT doc_id, round((contains(whole, 'the')::INTEGER + contains(whole, 'a b')::INTEGER + contains(whole, '.')::INTEGER)::DOUBLE / 3 * 100, 2) AS found FROM plain""")
def eval_snippets(spark, sf_dir):
    snippets = F.array(*map(F.lit, (" the", "a \n b", ".")))
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", O.snippets_found(snippets, F.col("text")).alias("found"))


@query("""WITH fixtures AS (SELECT source, doc_id % 40 AS fixture, round(avg(doc_id % 101), 2) AS score FROM documents GROUP BY ALL)
  SELECT source, round(avg(score), 2) AS mean, count(*) AS fixtures FROM fixtures GROUP BY source""")
def eval_macro(spark, sf_dir):
    fixtures = table(spark, sf_dir, "documents").groupBy("source", (F.col("doc_id") % 40).alias("fixture")).agg(F.round(F.avg(F.col("doc_id") % 101), 2).alias("score"))
    return O.macro_means(fixtures, "source", "score")


@query("""SELECT doc_id, round((doc_id % 101 + coalesce(CASE WHEN doc_id % 3 > 0 THEN doc_id % 97 END, 100) + doc_id % 89 + doc_id % 83)::DOUBLE / 4, 2) AS overall FROM documents""")
def eval_overall(spark, sf_dir):
    d = F.col("doc_id")
    part = lambda n: (d % n).cast("double")
    return table(spark, sf_dir, "documents").select("doc_id", O.extraction_overall(part(101), F.when(d % 3 > 0, part(97)), part(89), part(83)).alias("overall"))


#: Payloads are {"a": one value, "b": a list, "source_doc": provenance}; the n-th expected one stands beside the n-th actual one.
@query("""WITH e AS (SELECT doc_id // 20 AS fixture, doc_id, doc_id % 50 AS a, doc_id % 3 AS b FROM documents WHERE doc_id % 2 = 0), c AS (SELECT doc_id // 20 AS fixture, doc_id, doc_id % 50 // 2 * 2 AS a, doc_id % 4 AS b FROM documents WHERE doc_id % 2 = 1),
  en AS (SELECT *, row_number() OVER (PARTITION BY fixture ORDER BY a::VARCHAR || ',', b, doc_id) AS n FROM e), cn AS (SELECT *, row_number() OVER (PARTITION BY fixture ORDER BY a::VARCHAR || ',', b, doc_id) AS n FROM c),
  scored AS (SELECT en.fixture, 3 AS leaves, coalesce((en.a = cn.a)::INTEGER + greatest(0, (en.b = cn.b)::INTEGER + 1 - CASE WHEN cn.b = 3 THEN 1 ELSE 0 END), 0) AS hits FROM en LEFT JOIN cn ON en.fixture = cn.fixture AND en.n = cn.n)
  SELECT fixture, sum(leaves)::BIGINT AS total, sum(hits)::BIGINT AS matched, round(sum(hits)::DOUBLE / sum(leaves) * 100, 2) AS score FROM scored GROUP BY fixture""")
def eval_field_accuracy(spark, sf_dir):
    d = F.col("doc_id")
    fixture = F.floor(d / 20)
    payload = lambda a, b, extra: F.concat(F.lit('{"a": '), a.cast("string"), F.lit(', "b": ['), b.cast("string"), F.lit(', "x  y"'), extra, F.lit('], "source_doc": '), d.cast("string"), F.lit("}"))
    docs = table(spark, sf_dir, "documents")
    row = lambda own: (fixture.alias("fixture"), F.lit("spec_value").alias("record_type"), own.alias("payload"))
    expected = docs.where(d % 2 == 0).select(*row(payload(d % 50, d % 3, F.lit(""))))
    actual = docs.where(d % 2 == 1).select(*row(payload(F.floor(d % 50 / 2) * 2, d % 4, F.when(d % 4 == 3, ', "more"').otherwise(""))))
    return O.field_accuracy(expected, actual, ("source_doc",)).where("total > 0").select("fixture", "total", "matched", "score")
