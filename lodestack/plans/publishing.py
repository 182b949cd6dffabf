"""Queries on topics, pages and what is published."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestack.functions import duck
from lodestack.functions import vocabulary as V
from lodestack.operators import publishing as O
from lodestack.operators import structure
from lodestack.plans.extraction import _ITEMS, _items
from lodestack.plans.registry import query
from lodestack.plans.views import TITLES, pick, table

_CONF = "(doc_id * 31 + section_no * 7) % 100 / 100.0"
_PLAIN_TITLE = "trim(regexp_replace(title, '\\s+', ' ', 'g'))"
_UNTRUSTED = f"""({_PLAIN_TITLE} = '' OR regexp_full_match({_PLAIN_TITLE}, '[A-Za-z]') OR regexp_full_match({_PLAIN_TITLE}, '(?:\\d+|(?:\\d+\\.)+|\\d+\\.)') OR {duck.fold(_PLAIN_TITLE)} IN ({', '.join("'" + t.replace("'", "''") + "'" for t in V.CARRYOVER_TITLES)})
  OR (length({_PLAIN_TITLE}) >= 80 AND len(string_split({_PLAIN_TITLE}, ' ')) >= 12 AND len(regexp_extract_all({_PLAIN_TITLE}, '(?:\\b[A-Z]-\\d+\\b|\\b\\d+-\\d+\\b|\\b\\d+\\b)')) >= 6))"""
_TOPIC = f"""CASE WHEN section_type = 'other' AND ({_CONF} < 0.8 OR {_UNTRUSTED}) THEN NULL {' '.join(f"WHEN section_type IN ({', '.join(repr(x) for x in s)}) AND record_type IN ({', '.join(repr(x) for x in r)}) THEN '{name}'" for name, (s, r, _) in O.TOPICS.items())} END"""


def _topics(spark, sf_dir):
    items = _items(spark, sf_dir)
    confidence = (F.col("doc_id") * 31 + F.col("section_no") * 7) % 100 / 100
    return items.withColumn("topic", O.topic(F.col("section_type"), F.col("record_type"), confidence, F.size(structure.reviewability(F.col("title"))) == 0))


@query(f"WITH {_ITEMS} SELECT item_id, section_no, {_TOPIC} AS topic FROM sized")
def topic_classify(spark, sf_dir):
    return _topics(spark, sf_dir).select("item_id", "section_no", "topic")


@query(f"WITH {_ITEMS}, topics AS (SELECT *, {_TOPIC} AS topic FROM sized) SELECT topic, count(*) AS claims, count(DISTINCT doc_id) AS documents FROM topics WHERE topic IS NOT NULL GROUP BY topic")
def topic_claims(spark, sf_dir):
    return _topics(spark, sf_dir).where("topic IS NOT NULL").groupBy("topic").agg(F.count(F.lit(1)).alias("claims"), F.count_distinct("doc_id").alias("documents"))


@query("""WITH cited AS (SELECT source, lang || '/M' || doc_id % 3 AS scope, '[Source: d' || doc_id || ', ' || CASE WHEN doc_id % 4 = 0 THEN 'p.' || (doc_id % 9 + 1) ELSE 'pp.' || (doc_id % 9 + 1) || '-' || (doc_id % 9 + 1 + doc_id % 4) END || ']' AS citation FROM documents),
  several AS (SELECT source FROM cited GROUP BY source HAVING count(DISTINCT scope) > 1)
  SELECT DISTINCT source, scope, citation FROM cited JOIN several USING (source)""")
def applicability_notes(spark, sf_dir):
    d = F.col("doc_id")
    first, last = d % 9 + 1, d % 9 + 1 + d % 4
    cited = table(spark, sf_dir, "documents").select(
        "source", F.concat("lang", F.lit("/M"), d % 3).alias("scope"), F.concat(F.lit("[Source: d"), d, F.lit(", "), O.page_label(first, last), F.lit("]")).alias("citation")
    )
    several = cited.groupBy("source").agg(F.count_distinct("scope").alias("n")).where("n > 1").select("source")
    return cited.distinct().join(several, "source", "left_semi").select("source", "scope", "citation")


@query(f"""WITH {_ITEMS}, counted AS (SELECT doc_id, record_type, count(*) AS n, count(*) FILTER (WHERE {_CONF} < 0.75) AS low FROM sized GROUP BY doc_id, record_type)
  SELECT doc_id, string_agg(record_type || ': ' || n, ', ' ORDER BY record_type) AS records, sum(n)::BIGINT AS total, sum(low)::BIGINT AS low FROM counted GROUP BY doc_id""")
def source_page(spark, sf_dir):
    confidence = (F.col("doc_id") * 31 + F.col("section_no") * 7) % 100 / 100
    counted = _items(spark, sf_dir).groupBy("doc_id", "record_type").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(confidence < 0.75, 1)).alias("low"))
    line = F.concat("record_type", F.lit(": "), "n")
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record_type", line.alias("line")))), lambda x: x["line"]), ", ")
    return counted.groupBy("doc_id").agg(ordered.alias("records"), F.sum("n").alias("total"), F.sum("low").alias("low"))


_PAGES_SQL = f"""staged AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'topic' WHEN 1 THEN 'source' WHEN 2 THEN 'contradiction' ELSE 'overview' END AS kind, {duck.pick(tuple(O.TOPICS), 'doc_id // 4')} AS topic,
  {duck.pick(TITLES, 'doc_id')} AS title FROM documents),
placed AS (SELECT doc_id, kind, title, {duck.slug('title')} || '-' || doc_id % 300 AS slug, CASE WHEN kind = 'source' THEN 'source-index' WHEN kind = 'contradiction' THEN 'contradictions'
  WHEN kind = 'topic' THEN CASE topic {' '.join(f"WHEN '{n}' THEN '{w}'" for n, (_, _, w) in O.TOPICS.items())} END END AS folder FROM staged),
published AS (SELECT doc_id, kind, title, slug, 'publish/' || folder || '/' || slug || '.md' AS path FROM placed WHERE folder IS NOT NULL)"""


def _published(spark, sf_dir):
    from lodestack.functions import strings as S

    d = F.col("doc_id")
    kind = F.when(d % 4 == 0, "topic").when(d % 4 == 1, "source").when(d % 4 == 2, "contradiction").otherwise("overview")
    title = pick(TITLES, d)
    pages = table(spark, sf_dir, "documents").select("doc_id", kind.alias("kind"), pick(tuple(O.TOPICS), F.floor(d / 4)).alias("topic"), title.alias("title"), F.concat(S.slug(title), F.lit("-"), d % 300).alias("slug"))
    return O.stage(pages)


@query(f"WITH {_PAGES_SQL} SELECT doc_id, kind, path FROM published")
def publish_stage(spark, sf_dir):
    return _published(spark, sf_dir).select("doc_id", "kind", "path")


@query(f"""WITH {_PAGES_SQL}, known AS (SELECT doc_id, path, CASE WHEN doc_id % 3 = 0 THEN title ELSE slug END AS title, slug, 'k' || doc_id % 400 AS identity, list_filter(['title', CASE WHEN doc_id % 5 <> 0 THEN 'type' END, CASE WHEN doc_id % 7 <> 0 THEN 'status' END, 'generated_by'], lambda f: f IS NOT NULL) AS fields FROM published),
  judged AS (SELECT doc_id, path, list_filter([CASE WHEN len(fields) < 4 THEN 'missing:' || array_to_string(list_filter(['status', 'type'], lambda f: NOT list_contains(fields, f)), '+') END,
    CASE WHEN slug <> {duck.slug('title')} THEN 'slug' END, CASE WHEN path <> min(path) OVER (PARTITION BY identity) THEN 'duplicate:' || min(path) OVER (PARTITION BY identity) END], lambda e: e IS NOT NULL) AS errors FROM known)
  SELECT doc_id, path, array_to_string(errors, ' ') AS errors FROM judged""")
def publish_validate(spark, sf_dir):
    d = F.col("doc_id")
    pages = _published(spark, sf_dir).select(
        "doc_id",
        "path",
        F.when(d % 3 == 0, F.col("title")).otherwise(F.col("slug")).alias("title"),
        "slug",
        F.concat(F.lit("k"), d % 400).alias("identity"),
        F.array_compact(F.array(F.lit("title"), F.when(d % 5 != 0, "type"), F.when(d % 7 != 0, "status"), F.lit("generated_by"))).alias("fields"),
    )
    return O.validate(pages).select("doc_id", "path", F.array_join("errors", " ").alias("errors"))


@query(f"""WITH {_PAGES_SQL}, named AS (SELECT path || '#' || doc_id AS path, doc_id FROM published), new_files AS (SELECT path, sha256(path) AS digest FROM named WHERE doc_id % 6 <> 0),
  old_files AS (SELECT path, doc_id, CASE WHEN doc_id % 10 = 1 THEN 'x' ELSE sha256(path) END AS digest FROM named WHERE doc_id % 5 <> 0)
  SELECT coalesce(n.path, o.path) AS path, CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' WHEN n.digest <> o.digest THEN 'updated' ELSE 'unchanged' END AS change
  FROM new_files n FULL JOIN old_files o ON n.path = o.path WHERE n.path IS NOT NULL OR o.doc_id % 4 <> 0""")
def publish_diff(spark, sf_dir):
    d = F.col("doc_id")
    named = _published(spark, sf_dir).select("doc_id", F.concat("path", F.lit("#"), "doc_id").alias("path"))
    staged = named.where(d % 6 != 0).withColumn("digest", F.sha2("path", 256))
    target = named.where(d % 5 != 0).withColumn("digest", F.when(d % 10 == 1, "x").otherwise(F.sha2("path", 256)))
    return O.diff(staged, target, named.where(d % 4 != 0))


@query("""SELECT doc_id, '| a | ' || doc_id || ' |' || chr(10) || '| --- | --- |' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '|  |  |' ELSE '| ' || source || ' |  |' END AS markdown FROM documents""")
def table_markdown(spark, sf_dir):
    head = F.array(F.lit("a"), F.col("doc_id").cast("string"))
    data = F.when(F.col("doc_id") % 3 == 0, F.array(head)).otherwise(F.array(head, F.array("source")))
    return table(spark, sf_dir, "documents").select("doc_id", O.table_markdown(data).alias("markdown"))




_CITE = "CASE idx % 5 WHEN 1 THEN '[Source: d' || doc_id || ', p.1] x' WHEN 3 THEN line || ' [Source: d2, p.3]' ELSE line END"


@query(f"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), lines AS (SELECT doc_id, unnest(range(0, len(parts))) AS idx, unnest(parts) AS line FROM split),
  cited AS (SELECT doc_id, idx, {_CITE} AS raw FROM lines), solid AS (SELECT *, starts_with(trim(raw), '[Source:') AS tail FROM cited WHERE trim(raw) <> ''),
  seen AS (SELECT *, row_number() OVER w = 1 AS is_first, coalesce(lead(tail) OVER w, false) AS followed FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
  heads AS (SELECT *, (NOT tail OR is_first) AND (contains(raw, '[Source:') OR followed) AS head FROM seen),
  placed AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING)::BIGINT AS place FROM heads WHERE head OR tail)
  SELECT doc_id, place, sha256(string_agg(CASE WHEN head THEN rtrim(raw) ELSE trim(raw) END, ' ' ORDER BY idx)) AS line FROM placed GROUP BY doc_id, place""")
def cited_lines(spark, sf_dir):
    n = F.col("idx") % 5
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("idx", "line"))
    raw = F.when(n == 1, F.concat(F.lit("[Source: d"), "doc_id", F.lit(", p.1] x"))).when(n == 3, F.concat("line", F.lit(" [Source: d2, p.3]"))).otherwise(F.col("line"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", raw.alias("raw")))), lambda x: x["raw"]), "\n")
    return O.cited_lines(lines.groupBy("doc_id").agg(whole.alias("text"))).withColumn("line", F.sha2("line", 256))


@query("""WITH records AS (SELECT doc_id, source, (doc_id * 37) % 100 / 100.0 AS confidence FROM documents), limits AS (SELECT source, min((doc_id % 9) / 10.0) AS lim FROM documents WHERE doc_id % 40 = 3 AND doc_id % 9 > 0 GROUP BY source)
  SELECT doc_id, records.source FROM records LEFT JOIN limits ON records.source = limits.source WHERE confidence < coalesce(lim, 0.75)""")
def low_confidence(spark, sf_dir):
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents")
    records = docs.select("doc_id", "source", ((d * 37) % 100 / 100).alias("confidence"))
    return O.low_confidence(records, docs.where(d % 40 == 3).select("source", (d % 9 / 10).alias("min_confidence")), "source").select("doc_id", "source")


@query("""WITH c AS (SELECT event_id, 'r' || event_id % 3000 || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '::step-001' ELSE '::warning-002' END AS claim_id FROM events), r AS (SELECT 'r' || doc_id AS record_id FROM documents WHERE doc_id % 2 = 0)
  SELECT event_id, claim_id FROM c WHERE string_split(claim_id, '::')[1] IN (SELECT record_id FROM r)""")
def note_matches(spark, sf_dir):
    e = F.col("event_id")
    part = F.when(e % 3 == 0, "").when(e % 3 == 1, "::step-001").otherwise("::warning-002")
    candidates = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("r"), e % 3000, part).alias("claim_id"))
    records = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.concat(F.lit("r"), "doc_id").alias("record_id"))
    return O.notes_of_records(candidates, records).select("event_id", "claim_id")


_DIGESTS = ("workflow-guidance", "fault-code", "controller", "symptom")


@query(f"""WITH d AS (SELECT doc_id, {duck.slug('source')} AS a, {duck.slug('lang')} AS b, {duck.pick(_DIGESTS, 'doc_id')} AS c FROM documents)
  SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([a, b, c, CASE WHEN c = 'controller' THEN 'controller-family' END], lambda t: t IS NOT NULL))), ',') AS tags FROM d""")
def digest_tags(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(O.tags(docs.source, docs.lang, pick(_DIGESTS, docs.doc_id)), ",").alias("tags"))


@query("SELECT user_id AS doc_id, event_type AS locator, min(event_id) AS first_event FROM events GROUP BY user_id, event_type")
def source_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("locator"), F.col("event_id").alias("first_event"))
    return O.first_sources(rows, "first_event")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def latest_runs(spark, sf_dir):
    return table(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id", "user_id", "event_type")


_BODY = "CASE WHEN doc_id % 7 = 0 THEN '## Field Guidance' || chr(10) ELSE '' END || '## Summary' || chr(10) || coalesce(text, '') || CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 5 = 0 THEN chr(10) || '## Field Guidances' || chr(10) ELSE chr(10) || '## Field Guidance' || chr(10) END || chr(10) || '## Source Citations' || chr(10) || CASE WHEN doc_id % 11 <> 3 THEN '## Related Pages' || chr(10) ELSE '' END"


@query(f"""WITH bodies AS (SELECT doc_id, chr(10) || {_BODY} AS body FROM documents), found AS (SELECT doc_id, [strpos(body, chr(10) || h || chr(10)) for h in ['## Summary', '## Field Guidance', '## Source Citations', '## Related Pages']] AS places FROM bodies),
  named AS (SELECT doc_id, places, list_filter([CASE WHEN places[k] = 0 THEN 'missing:' || ['## Summary', '## Field Guidance', '## Source Citations', '## Related Pages'][k] END for k in [1, 2, 3, 4]], lambda e: e IS NOT NULL) AS lacking FROM found)
  SELECT doc_id, CASE WHEN len(lacking) > 0 THEN array_to_string(lacking, ';') WHEN places <> list_sort(places) THEN 'order' ELSE '' END AS errors FROM named""")
def page_sections(spark, sf_dir):
    """Bodies with all sections, without some, and in another order."""
    d, line = F.col("doc_id"), lambda x: F.lit(f"{x}\n")
    body = F.concat(
        F.when(d % 7 == 0, line("## Field Guidance")).otherwise(""), line("## Summary"), F.coalesce("text", F.lit("")),
        F.when(d % 7 == 0, "").when(d % 5 == 0, line("\n## Field Guidances")).otherwise(line("\n## Field Guidance")), line("\n## Source Citations"), F.when(d % 11 != 3, line("## Related Pages")).otherwise(""),
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(O.body_errors(body), ";").alias("errors"))


@query("""WITH listed AS (SELECT 'm' || (doc_id % 50) AS manifest, ['written', 'updated', 'removed'][doc_id % 3 + 1] AS change, ['controllers/', 'symptoms/', '/abs/', 'controllers/../', 'drafts/', '_sources/'][doc_id % 6 + 1] || doc_id || '.md' AS path, doc_id % 6 AS k, doc_id FROM documents)
  SELECT manifest, path, CASE k WHEN 2 THEN 'absolute' WHEN 3 THEN 'climbs' ELSE 'folder' END AS error FROM listed WHERE k IN (2, 3, 4)
  UNION ALL SELECT manifest, path, 'orphan' FROM listed WHERE change = 'removed' AND doc_id % 4 <> 0""")
def manifest_errors(spark, sf_dir):
    """Files listed by manifests, some badly; every fourth was published before."""
    d = F.col("doc_id")
    folder = F.element_at(F.array(*map(F.lit, ("controllers/", "symptoms/", "/abs/", "controllers/../", "drafts/", "_sources/"))), (d % 6 + 1).cast("int"))
    change = F.element_at(F.array(*map(F.lit, ("written", "updated", "removed"))), (d % 3 + 1).cast("int"))
    listed = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("m"), (d % 50).cast("string")).alias("manifest"), change.alias("change"), F.concat(folder, d.cast("string"), F.lit(".md")).alias("path"))
    return O.manifest_errors(listed.drop("doc_id"), listed.where("doc_id % 4 = 0"))
