"""Queries on text items, sections and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestack.functions import duck
from lodestack.functions import strings as S
from lodestack.functions import vocabulary as V
from lodestack.operators import sectioning as A
from lodestack.operators import structure as O
from lodestack.plans.registry import query
from lodestack.plans.views import ITEMS, MANIFESTS, TABLES, items, manifests, table, tables


@query(f"WITH {ITEMS} SELECT doc_id, idx, label, text, level, page FROM items")
def text_items(spark, sf_dir):
    return items(spark, sf_dir)


_PATHS = """headings AS (SELECT doc_id, idx, level, text FROM items WHERE level IS NOT NULL),
above AS (SELECT h.doc_id, h.idx, p.idx AS above_idx, p.text FROM headings h JOIN headings p ON p.doc_id = h.doc_id AND p.idx < h.idx AND p.level < h.level
  WHERE NOT EXISTS (SELECT 1 FROM headings q WHERE q.doc_id = h.doc_id AND q.idx > p.idx AND q.idx < h.idx AND q.level <= p.level)),
chains AS (SELECT doc_id, idx, max(above_idx) AS parent_idx, list(text ORDER BY above_idx) AS titles FROM above GROUP BY doc_id, idx),
paths AS (SELECT h.doc_id, h.idx, h.level, h.text, c.parent_idx, coalesce(c.titles, []) AS titles FROM headings h LEFT JOIN chains c USING (doc_id, idx))"""


def paths_of(spark, sf_dir):
    return A.heading_paths(items(spark, sf_dir).where("level IS NOT NULL").select("doc_id", "idx", "level", "text"))


@query(f"WITH {ITEMS}, {_PATHS} SELECT doc_id, idx, level, parent_idx, array_to_string(list_append(titles, text), ' > ') AS heading_path FROM paths")
def heading_tree(spark, sf_dir):
    return paths_of(spark, sf_dir).select("doc_id", "idx", "level", "parent_idx", F.array_join("path", " > ").alias("heading_path"))


@query(f"WITH {ITEMS} SELECT doc_id, idx, CASE label WHEN 'title' THEN 1 WHEN 'section_header' THEN 2 WHEN 'subtitle' THEN 2 WHEN 'page_header' THEN 3 END AS label_level FROM items WHERE label <> 'text' AND trim(text) <> ''")
def label_levels(spark, sf_dir):
    odd = items(spark, sf_dir).withColumn("label", F.when(F.col("idx") % 8 == 4, F.upper("label")).otherwise(F.col("label")))  # labels in any case
    return A.labelled_headings(odd).select("doc_id", "idx", F.col("level").alias("label_level"))


_PAGED = f"""{ITEMS}, paged AS (SELECT doc_id, idx, label, text, level, coalesce(
    last_value(page IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(page IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    least(5, (row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1) * 5 // count(*) OVER (PARTITION BY doc_id) + 1))::BIGINT AS page FROM items)"""


def _paged(spark, sf_dir):
    return O.infer_pages(items(spark, sf_dir), F.lit(5))


@query(f"WITH {_PAGED} SELECT doc_id, idx, page FROM paged")
def page_infer(spark, sf_dir):
    return _paged(spark, sf_dir).select("doc_id", "idx", "page")


@query(f"WITH {_PAGED} SELECT doc_id, page, count(*) AS items, sum(length(text))::BIGINT AS chars, count(*) FILTER (WHERE level IS NOT NULL) AS headings FROM paged GROUP BY doc_id, page")
def page_map(spark, sf_dir):
    return _paged(spark, sf_dir).groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("items"), F.sum(F.length("text")).alias("chars"), F.count("level").alias("headings"))


def _stripped(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


_NUMBERED = f"""{_PAGED}, {TABLES}, opened AS (SELECT *, label IN ('section_header', 'section_title', 'subtitle') AS opens FROM paged),
numbered AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS section_no,
  bool_or(opens) OVER (PARTITION BY doc_id) AS sectioned,
  first_value(CASE WHEN label IN ('title', 'document_title') THEN nullif({_stripped('text')}, '') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS document_title FROM opened)"""
_SECTIONED = f"""{_NUMBERED}, bounds AS (SELECT doc_id, section_no, any_value(sectioned) AS sectioned, any_value(document_title) AS document_title,
  max({_stripped('text')}) FILTER (WHERE opens) AS heading, max(level) FILTER (WHERE opens) AS level, max(idx) FILTER (WHERE opens) AS heading_idx, max(page) FILTER (WHERE opens) AS heading_page,
  min(page) FILTER (WHERE NOT opens) AS low, max(page) FILTER (WHERE NOT opens) AS high FROM numbered GROUP BY doc_id, section_no),
ranges AS (SELECT *, CASE WHEN section_no = 0 THEN 1 ELSE heading_page END AS start, lead(heading_page) OVER (PARTITION BY doc_id ORDER BY section_no) AS stop FROM bounds),
placed AS (SELECT t.doc_id, table_no, any_value(t.page) AS page, any_value(markdown) AS markdown, min(section_no) AS section_no FROM tables t JOIN ranges r ON r.doc_id = t.doc_id
  AND (NOT r.sectioned OR (r.start <= t.page AND (r.stop IS NULL OR t.page < r.stop))) GROUP BY t.doc_id, table_no),
bodies AS (SELECT doc_id, section_no, string_agg({_stripped('text')}, chr(10) || chr(10) ORDER BY idx) AS body FROM numbered WHERE label = 'text' AND {_stripped('text')} <> '' GROUP BY doc_id, section_no),
tabled AS (SELECT doc_id, section_no, string_agg(nullif(markdown, ''), chr(10) || chr(10) ORDER BY table_no) AS body, min(page) AS low, max(page) AS high FROM placed GROUP BY doc_id, section_no),
sections AS (SELECT * FROM (SELECT b.doc_id, b.section_no, CASE WHEN b.section_no > 0 THEN heading ELSE coalesce(document_title, CASE WHEN sectioned THEN 'Overview' ELSE b.doc_id::VARCHAR END) END AS title, level, heading_idx, heading_page, sectioned,
    coalesce(least(b.low, t.low), CASE WHEN b.section_no > 0 THEN heading_page END) AS page_from, coalesce(greatest(b.high, t.high), CASE WHEN b.section_no > 0 THEN heading_page END) AS page_to,
    {_stripped("array_to_string(list_filter(['## ' || nullif(heading, ''), x.body, t.body], lambda z: z IS NOT NULL), chr(10) || chr(10))")} AS content
  FROM bounds b LEFT JOIN bodies x USING (doc_id, section_no) LEFT JOIN tabled t USING (doc_id, section_no)) WHERE section_no > 0 OR NOT sectioned OR content <> '')"""


def numbered_of(spark, sf_dir):
    return A.numbered(_paged(spark, sf_dir))


def sections_of(spark, sf_dir):
    return A.sections(numbered_of(spark, sf_dir), tables(_paged(spark, sf_dir)))


@query(f"WITH {_SECTIONED} SELECT doc_id, section_no, title, page_from, page_to, sha256(content) AS content_hash FROM sections")
def sections(spark, sf_dir):
    return sections_of(spark, sf_dir).select("doc_id", "section_no", "title", "page_from", "page_to", F.sha2("content", 256).alias("content_hash"))


@query(f"WITH {_SECTIONED} SELECT doc_id, table_no, section_no FROM placed")
def section_tables(spark, sf_dir):
    bounds = A._bounds(numbered_of(spark, sf_dir))
    return A.placed_tables(tables(_paged(spark, sf_dir)), bounds).select("doc_id", "table_no", "section_no")


_PARENTS = f"""{_SECTIONED}, {_PATHS}, parents AS (SELECT s.doc_id, s.section_no, p.parent_idx, array_to_string(coalesce(p.titles, [])[2:], ' ') AS parent_titles
  FROM sections s LEFT JOIN paths p ON p.doc_id = s.doc_id AND p.idx = s.heading_idx)"""


def _with_paths(spark, sf_dir):
    found = paths_of(spark, sf_dir).select("doc_id", F.col("idx").alias("heading_idx"), "parent_idx", "path")
    inner = F.array_join(F.slice("path", 2, F.greatest(F.size("path") - 2, F.lit(0))), " ")
    return sections_of(spark, sf_dir).join(found, ["doc_id", "heading_idx"], "left").withColumn("parents", F.coalesce(F.when(F.size("path") > 2, inner), F.lit("")))


@query(f"""WITH {_PARENTS} SELECT p.doc_id, p.section_no, s.section_no AS parent, s.title AS parent_title FROM parents p LEFT JOIN sections s ON s.doc_id = p.doc_id AND s.heading_idx = p.parent_idx""")
def section_parent(spark, sf_dir):
    own = _with_paths(spark, sf_dir)
    above = sections_of(spark, sf_dir).select("doc_id", F.col("heading_idx").alias("parent_idx"), F.col("section_no").alias("parent"), F.col("title").alias("parent_title"))
    return own.join(above, ["doc_id", "parent_idx"], "left").select("doc_id", "section_no", "parent", "parent_title")


def _chain(haystacks, keywords):
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({h}, {w!r})' for w in words for h in haystacks)} THEN '{kind}'" for kind, words in keywords) + " END"


_LISTS = {"manual": V.MANUAL_KEYWORDS, "operational": V.OPERATIONAL_KEYWORDS, "drawing": V.DRAWING_KEYWORDS, "bulletin": V.BULLETIN_KEYWORDS}


def _tried(*haystacks):
    return "CASE context " + " ".join(f"WHEN '{name}' THEN {_chain(haystacks, sum((_LISTS[x] for x in order), ()))}" for name, order in V.CONTEXT_ORDERS.items()) + " END"


def _list(values):
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_CLASSIFIED = f"""{_PARENTS}, {MANIFESTS}, prepared AS (
  SELECT s.doc_id, s.section_no, s.title, s.content, {duck.classifier_text('parent_titles')} AS above, {duck.classifier_text('title')} AS plain, {duck.classifier_text('substr(content, 1, 500)')} AS inside, {duck.slug('document_type')} AS kind, document_class
  FROM sections s JOIN parents USING (doc_id, section_no) JOIN manifests USING (doc_id)),
stripped AS (SELECT *, trim(regexp_replace(plain, '^(?:step\\s+)?\\d+(?:\\.\\d+)*[).:\\-]?\\s*', '')) AS short,
  CASE WHEN kind IN {_list(V.CONTEXT_TYPES['operational'])} OR lower(document_class) = 'operational' THEN 'operational' WHEN kind IN {_list(V.CONTEXT_TYPES['drawing'])} THEN 'drawing'
    WHEN kind IN {_list(V.CONTEXT_TYPES['bulletin'])} THEN 'bulletin' ELSE 'manual' END AS context,
  CASE kind {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in V.DEFAULT_SECTION_TYPES.items())} END AS usual FROM prepared),
hinted AS (SELECT *, {' OR '.join(f"starts_with(short, '{p}')" for p in O.PROCEDURAL_STARTS)} AS procedural FROM stripped),
classified AS (SELECT doc_id, section_no, title, content, lower(trim(document_class)) = 'operational' AS operational, CASE WHEN plain IN {_list(V.ADMONITIONS)} OR short IN {_list(V.ADMONITIONS)} THEN 'safety' ELSE coalesce(
  {_tried('plain', 'short')},
  {_tried('above')},
  CASE WHEN plain NOT IN ('overview', 'notes', 'instructions') THEN usual END,
  CASE WHEN plain NOT IN {_list(O.NEUTRAL_TITLES)} AND (regexp_matches(plain, '^(?:step\\s+)?\\d') OR procedural OR (plain <> short AND short <> '')
    OR (len(list_filter(string_split(short, ' '), lambda w: w <> '')) <= 4 AND short NOT IN {_list(O.NEUTRAL_TITLES)})) THEN {_tried('inside')} END,
  CASE WHEN regexp_matches(trim(title), '^(?i:step\\s+)?\\d') OR procedural THEN 'workflow' END, 'other') END AS section_type FROM hinted)"""


def classified_sections(spark, sf_dir):
    known = manifests(spark, sf_dir).select("doc_id", "document_type", "document_class")
    return O.classify(_with_paths(spark, sf_dir).join(known, "doc_id"))


@query(f"WITH {_CLASSIFIED} SELECT doc_id, section_no, section_type FROM classified")
def section_classify(spark, sf_dir):
    return classified_sections(spark, sf_dir).select("doc_id", "section_no", "section_type")


_LINES = f"lines_of AS (SELECT n.doc_id, n.section_no, n.idx, n.page, {_stripped('n.text')} AS line FROM numbered n WHERE label = 'text' AND {_stripped('n.text')} <> '')"


@query(f"""WITH {_CLASSIFIED}, {_LINES}, known AS (SELECT * FROM classified WHERE operational OR section_type IN {_list(A.STEP_TYPES)}),
  parsed AS (SELECT l.*, section_type, CASE WHEN regexp_matches(line, '(?i)^(?:step\\s+)?\\d+[).:\\-]?\\s+.+$') THEN regexp_extract(line, '(?i)^(?:step\\s+)?(\\d+)[).:\\-]?\\s+(.+)$', 2)
      WHEN regexp_matches(line, '^(?:[-*•]\\s+)?\\[[ xX]\\]\\s+.+$') THEN regexp_extract(line, '^(?:[-*•]\\s+)?\\[[ xX]\\]\\s+(.+)$', 1)
      WHEN section_type = 'checklist' AND regexp_matches(line, '^[-*•]\\s+.+$') THEN regexp_extract(line, '^[-*•]\\s+(.+)$', 1) END AS found,
    nullif(try_cast(regexp_extract(line, '(?i)^(?:step\\s+)?(\\d+)[).:\\-]?\\s+(.+)$', 1) AS BIGINT), 0) AS given FROM lines_of l JOIN known USING (doc_id, section_no)),
  kept AS (SELECT * FROM (SELECT *, count(found) OVER (PARTITION BY doc_id, section_no) AS founds FROM parsed) WHERE found IS NOT NULL OR (founds = 0 AND section_type IN {_list(A.STEP_TYPES)})),
  runs AS (SELECT *, count(given) OVER (PARTITION BY doc_id, section_no ORDER BY idx ROWS UNBOUNDED PRECEDING) AS run FROM kept)
  SELECT doc_id, section_no, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY idx) AS place, coalesce(found, line) AS body, page,
    (coalesce(first_value(given) OVER (PARTITION BY doc_id, section_no, run ORDER BY idx), 1) + row_number() OVER (PARTITION BY doc_id, section_no, run ORDER BY idx) - 1)::BIGINT AS step_no FROM runs""")
def section_steps(spark, sf_dir):
    typed = classified_sections(spark, sf_dir).withColumn("operational", S.strip(S.fold(F.col("document_class"))) == "operational")
    return A.steps(numbered_of(spark, sf_dir), typed)


@query(f"""WITH {_CLASSIFIED}, {_LINES}, marked AS (SELECT l.*, title, regexp_matches(line, '(?i)^(figure|fig\\.?|diagram|drawing|wiring diagram|schematic|p&id)[A-Za-z0-9.\\- ]*$') AS is_label
    FROM lines_of l JOIN classified USING (doc_id, section_no) WHERE section_type IN {_list(A.FIGURE_TYPES)}),
  placed_lines AS (SELECT *, sum(CASE WHEN is_label THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, section_no ORDER BY idx ROWS UNBOUNDED PRECEDING)::BIGINT AS region FROM marked)
  SELECT doc_id, section_no, region, coalesce(max(line) FILTER (WHERE is_label), any_value(title)) AS label, arg_min(page, idx) AS page,
    coalesce(string_agg(line, '|' ORDER BY idx) FILTER (WHERE NOT is_label AND regexp_matches(line, '(?i)^(?:callout\\s+)?(?:[A-Z]{{1,3}}|\\d{{1,3}}|[A-Z]\\d{{1,2}})[).:\\-]\\s+.+$')), '') AS callouts FROM placed_lines GROUP BY doc_id, section_no, region""")
def section_figures(spark, sf_dir):
    return A.figure_regions(numbered_of(spark, sf_dir), classified_sections(spark, sf_dir)).withColumn("callouts", F.array_join("callouts", "|"))


SECTION_ID = f"'d' || doc_id || '--' || substr({duck.slug('title')}, 1, 80) || '--' || substr(sha256('d' || doc_id || chr(10) || trim(title) || chr(10) || regexp_replace(content, '^\\s+|\\s+$', '', 'g')), 1, 12)"


@query(f"WITH {_SECTIONED} SELECT doc_id, section_no, {SECTION_ID} AS section_id FROM sections")
def section_ids(spark, sf_dir):
    s = sections_of(spark, sf_dir)
    return s.select("doc_id", "section_no", O.section_id(F.concat(F.lit("d"), s.doc_id.cast("string")), s.title, s.content).alias("section_id"))


@query(f"""WITH {_SECTIONED}, titled AS (SELECT doc_id, section_no, CASE WHEN section_no % 7 = 0 THEN '  ' WHEN section_no % 7 = 1 THEN 'Contents 1-1 1-2 A-3 4 5 6 7 8 9 10 11 12 13 14 of this long manual on all parts and their uses and tables' ELSE title END AS title FROM sections),
  plain AS (SELECT doc_id, section_no, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS t FROM titled)
  SELECT doc_id, section_no, CASE WHEN t = '' THEN 'empty_title' ELSE array_to_string(list_sort(list_filter([
    CASE WHEN regexp_full_match(t, '[A-Za-z]') THEN 'single_letter_title' END,
    CASE WHEN regexp_full_match(t, '(?:\\d+|(?:\\d+\\.)+|\\d+\\.)') THEN 'numeric_fragment_title' END,
    CASE WHEN {duck.fold('t')} IN {_list(V.CARRYOVER_TITLES)} THEN 'generic_carryover_title' END,
    CASE WHEN length(t) >= 80 AND len(string_split(t, ' ')) >= 12 AND len(regexp_extract_all(t, '(?:\\b[A-Z]-\\d+\\b|\\b\\d+-\\d+\\b|\\b\\d+\\b)')) >= 6 THEN 'toc_fragment_title' END], lambda r: r IS NOT NULL)), ',') END AS reasons FROM plain""")
def reviewability(spark, sf_dir):
    s = sections_of(spark, sf_dir)
    n = F.col("section_no") % 7
    title = F.when(n == 0, "  ").when(n == 1, "Contents 1-1 1-2 A-3 4 5 6 7 8 9 10 11 12 13 14 of this long manual on all parts and their uses and tables").otherwise(F.col("title"))
    return s.select("doc_id", "section_no", F.array_join(O.reviewability(title), ",").alias("reasons"))


_PAGES = f"""{_PAGED}, pages_of AS (SELECT doc_id, page, sum(length(regexp_replace(text, '\\s', '', 'g')))::DOUBLE / 93.5 AS density, (doc_id + page) % 5 <> 0 AS has_text, (doc_id + page) % 2 = 0 AS has_vector FROM paged GROUP BY doc_id, page),
counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS page_count FROM pages_of)"""


@query(f"""WITH {_PAGES} SELECT doc_id, page, CASE WHEN doc_id % 6 = 0 THEN 'bypass' WHEN has_vector AND NOT has_text THEN 'vector'
    WHEN NOT has_text OR (CASE WHEN page_count >= 25 THEN 200.0 ELSE density END) < 5.0 THEN 'ocr' ELSE 'keep' END AS decision,
  round(least(density / 20.0, 1.0), 3) AS confidence FROM counted""")
def ocr_decision(spark, sf_dir):
    paged = _paged(spark, sf_dir)
    n = F.col("doc_id") + F.col("page")
    chars = paged.groupBy("doc_id", "page").agg(F.sum(O.visible_chars(F.col("text"))).alias("chars"))
    by_page = chars.withColumn("density", O.text_density(F.col("chars"), F.lit(8.5), F.lit(11.0)))
    counts = by_page.groupBy("doc_id").agg(F.count(F.lit(1)).alias("page_count"))
    known = by_page.join(counts, "doc_id")
    decision = O.ocr_decision(n % 5 != 0, n % 2 == 0, F.col("density"), F.col("page_count"), F.col("doc_id") % 6 == 0, threshold=5.0, target=200.0)
    return known.select("doc_id", "page", decision.alias("decision"), O.ocr_confidence(F.col("density"), 20.0).alias("confidence"))


@query(f"""WITH {_PAGED}, {_PATHS}, depths AS (SELECT doc_id, max(len(titles)) + 1 AS deep FROM paths GROUP BY doc_id), {TABLES}, good AS (SELECT doc_id, count(*) AS tables, count(*) FILTER (WHERE page IS NOT NULL AND markdown <> '') AS good_tables FROM tables GROUP BY doc_id),
  counts AS (SELECT doc_id, count(level) AS headings, count(*) FILTER (WHERE label = 'section_header') + doc_id % 3 AS candidates,
    coalesce(any_value(g.tables), 0) AS tables, coalesce(any_value(g.good_tables), 0) AS good_tables,
    sum(length(regexp_replace(text, '\\s', '', 'g'))) AS markdown_chars, sum(length(text)) AS text_chars, any_value(deep) AS depth, min(level) AS min_level, max(level) AS max_level,
    count(DISTINCT page) AS mapped_pages, max(page) + doc_id % 2 AS page_count FROM paged LEFT JOIN depths USING (doc_id) LEFT JOIN good g USING (doc_id) GROUP BY doc_id),
  scored AS (SELECT doc_id, CASE WHEN candidates = 0 THEN CASE WHEN headings = 0 THEN 100.0 ELSE 0.0 END ELSE least(headings / candidates, 1.0) * 100 END AS h,
    CASE WHEN tables = 0 THEN 100.0 ELSE good_tables / tables * 100 END AS t, CASE WHEN text_chars = 0 THEN 0.0 ELSE least(markdown_chars / text_chars, 1.0) * 100 END AS x,
    (least(depth / 3, 1.0) * 0.6::DOUBLE + least((max_level - min_level + 1) / 3, 1.0) * 0.4::DOUBLE) * 100 AS d, least(mapped_pages / page_count, 1.0) * 100 AS p FROM counts)
  SELECT doc_id, round(h::DOUBLE, 6) AS heading_coverage, round(t::DOUBLE, 6) AS table_rate, round(x::DOUBLE, 6) AS text_completeness, round(d::DOUBLE, 6) AS structure_depth, round(p::DOUBLE, 6) AS page_coverage,
    round(h::DOUBLE * 0.25::DOUBLE + t::DOUBLE * 0.2::DOUBLE + x::DOUBLE * 0.25::DOUBLE + d::DOUBLE * 0.15::DOUBLE + p::DOUBLE * 0.15::DOUBLE, 2) AS overall FROM scored""")
def parse_quality(spark, sf_dir):
    paged = _paged(spark, sf_dir)
    good = F.col("page").isNotNull() & (F.size("data") > 0)
    found = tables(paged).groupBy("doc_id").agg(F.count(F.lit(1)).alias("tables"), F.count(F.when(good, 1)).alias("good_tables"))
    depths = A.heading_depths(paths_of(spark, sf_dir))
    chars = F.length(F.regexp_replace("text", r"(?U)\s", ""))
    counts = (
        paged.groupBy("doc_id")
        .agg(
            F.count("level").alias("headings"),
            (F.count(F.when(F.col("label") == "section_header", 1)) + F.col("doc_id") % 3).alias("candidates"),
            F.sum(chars).alias("markdown_chars"),
            F.sum(F.length("text")).alias("text_chars"),
            F.min("level").alias("min_level"),
            F.max("level").alias("max_level"),
            F.count_distinct("page").alias("mapped_pages"),
            (F.max("page") + F.col("doc_id") % 2).alias("page_count"),
        )
        .join(depths, "doc_id", "left")
        .join(found, "doc_id", "left")
        .fillna(0, ["tables", "good_tables"])
    )
    scores = ["heading_coverage", "table_rate", "text_completeness", "structure_depth", "page_coverage"]
    return O.quality(counts).select("doc_id", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in scores], F.col("overall").cast("double").alias("overall"))


@query("""WITH runs AS (SELECT doc_id, p AS parser, (doc_id * 7 + p * 13) % 5 * 10 AS score FROM documents, (SELECT unnest([0, 1]) AS p))
  SELECT doc_id, CASE WHEN max(score) FILTER (WHERE parser = 1) > max(score) FILTER (WHERE parser = 0) THEN 'fallback' ELSE 'primary' END AS chosen, max(score) AS score FROM runs GROUP BY doc_id""")
def parse_select(spark, sf_dir):
    p = F.explode(F.array(F.lit(0), F.lit(1)))
    runs = table(spark, sf_dir, "documents").select("doc_id", p.alias("parser")).withColumn("score", (F.col("doc_id") * 7 + F.col("parser") * 13) % 5 * 10)
    best = F.max(F.struct("score", (1 - F.col("parser")).alias("is_primary")))
    return runs.groupBy("doc_id").agg(best.alias("best")).select("doc_id", F.when(F.col("best.is_primary") == 1, "primary").otherwise("fallback").alias("chosen"), F.col("best.score").alias("score"))


_HTML_BARE = "regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', '', 'g'), '(?is)<style\\b.*?</style>', '', 'g'), '(?is)<nav\\b.*?</nav>', '', 'g')"
_HTML_TAGS = (("title", r"(?is)<title\b[^>]*>(.*?)</title>"), ("section_header", r"(?is)<h1\b[^>]*>(.*?)</h1>"), ("text", r"(?is)<p\b[^>]*>(.*?)</p>"))
_HTML_ITEMS = " UNION ALL ".join(f"SELECT page_id, '{label}' AS label, unnest(regexp_extract_all(html, '{pattern}', 1)) AS raw FROM bare" for label, pattern in _HTML_TAGS)


@query(f"""WITH bare AS (SELECT page_id, {_HTML_BARE} AS html FROM pages), found AS ({_HTML_ITEMS}), texts AS (SELECT page_id, label, trim(regexp_replace(regexp_replace(raw, '<[^>]*>', '', 'g'), '[ \t\r\n]+', ' ', 'g')) AS own FROM found)
  SELECT page_id, label, count(*) AS items, sum(length(own))::BIGINT AS chars FROM texts WHERE own <> '' GROUP BY page_id, label""")
def html_to_items(spark, sf_dir):
    """Titles, headings and paragraphs of whole pages without scripts, styles and menus; inner markup leaves its text."""
    bare = F.col("html")
    for tag in ("script", "style", "nav"):
        bare = F.regexp_replace(bare, rf"(?is)<{tag}\b.*?</{tag}>", "")
    pages = table(spark, sf_dir, "pages").select("page_id", bare.alias("html"))
    found = F.array(*[F.struct(F.lit(label).alias("label"), F.regexp_extract_all("html", F.lit(pattern)).alias("raws")) for label, pattern in _HTML_TAGS])
    rows = pages.select("page_id", F.explode(found).alias("kind")).select("page_id", F.col("kind.label").alias("label"), F.explode("kind.raws").alias("raw"))
    own = F.trim(F.regexp_replace(F.regexp_replace("raw", "<[^>]*>", ""), "[ \t\r\n]+", " "))
    return rows.select("page_id", "label", own.alias("own")).where("own <> ''").groupBy("page_id", "label").agg(F.count(F.lit(1)).alias("items"), F.sum(F.length("own")).alias("chars"))


_MARKED = "CASE WHEN idx % 5 = 0 THEN '## ' || line ELSE line END || CASE WHEN idx % 3 = 2 THEN chr(10) || ' ' ELSE '' END"


@query(f"""WITH {ITEMS}, pages_md AS (SELECT doc_id, string_agg({_MARKED}, chr(10) ORDER BY idx) AS md FROM lines WHERE trim(line) <> '' GROUP BY doc_id),
  parts AS (SELECT doc_id, list_filter(regexp_split_to_array(md, '\\n[ \\t]*\\n'), lambda p: trim(p) <> '') AS ps FROM pages_md),
  rows_md AS (SELECT doc_id, unnest(range(0, len(ps))) AS idx, regexp_replace(unnest(ps), '^\\s+|\\s+$', '', 'g') AS body FROM parts)
  SELECT doc_id, idx, CASE WHEN regexp_matches(body, '^#{{1,6}}\\s+\\S') THEN 'section_header' ELSE 'text' END AS label, length(regexp_replace(body, '^#{{1,6}}\\s+', '')) AS chars FROM rows_md""")
def markdown_items(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("idx", "line")).where(F.trim("line") != "")
    marked = F.concat(F.when(F.col("idx") % 5 == 0, F.concat(F.lit("## "), "line")).otherwise(F.col("line")), F.when(F.col("idx") % 3 == 2, "\n ").otherwise(""))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", marked.alias("m")))), lambda x: x["m"]), "\n")
    return O.markdown_items(lines.groupBy("doc_id").agg(whole.alias("text"))).select("doc_id", "idx", "label", F.length("text").cast("long").alias("chars"))


_BLANKED = "CASE WHEN doc_id % 4 = 0 AND idx % 4 = 0 THEN 'text' ELSE label END AS label, CASE WHEN doc_id % 8 = 0 AND idx < 2 THEN '  ' ELSE text END AS text"


def _without_headings(spark, sf_dir):
    """Items of which a quarter of the documents has no headings, and some of these begin with blank lines."""
    d, i = F.col("doc_id"), F.col("idx")
    return items(spark, sf_dir).withColumns({"label": F.when((d % 4 == 0) & (i % 4 == 0), "text").otherwise(F.col("label")), "text": F.when((d % 8 == 0) & (i < 2), "  ").otherwise(F.col("text"))})


@query(f"""WITH {ITEMS}, blanked AS (SELECT doc_id, idx, {_BLANKED} FROM items), own AS (SELECT doc_id, idx, trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS t, CASE label WHEN 'title' THEN 1 WHEN 'section_header' THEN 2 END AS level FROM blanked),
  found AS (SELECT doc_id, idx, level, t AS title FROM own WHERE level IS NOT NULL AND t <> ''), firsts AS (SELECT doc_id, min(idx) AS idx FROM own WHERE t <> '' AND doc_id NOT IN (SELECT doc_id FROM found) GROUP BY doc_id)
  SELECT doc_id, idx, level, title FROM found UNION ALL SELECT doc_id, idx, 1, substr(t, 1, 120) FROM own JOIN firsts USING (doc_id, idx)""")
def fallback_headings(spark, sf_dir):
    return A.fallback_headings(_without_headings(spark, sf_dir))


_COUNTS = "counts AS (SELECT doc_id, coalesce(CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 END, CASE WHEN doc_id % 7 > 2 THEN doc_id % 7 END, 0) AS page_count FROM documents)"


def _page_counts(spark, sf_dir):
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", A.page_count(d % 3, F.when(d % 7 > 2, d % 7)).alias("page_count"))


@query(f"WITH {_COUNTS} SELECT doc_id, page_count FROM counts")
def page_counts(spark, sf_dir):
    return _page_counts(spark, sf_dir)


@query(f"WITH {_COUNTS} SELECT doc_id, unnest(range(1, page_count + 1)) AS page FROM counts WHERE page_count > 0")
def fallback_pages(spark, sf_dir):
    return A.fallback_pages(_page_counts(spark, sf_dir))


_REFS = f"""{ITEMS}, refs AS (SELECT doc_id, 0 AS kind, idx AS place, CASE WHEN idx % 9 <> 5 THEN 't' || idx END AS item_ref, page FROM items WHERE idx % 8 <> 3
  UNION ALL SELECT doc_id, 1, idx, 'b' || idx, page FROM items WHERE idx % 8 = 3)"""


def _refs(spark, sf_dir):
    i = F.col("idx")
    own = items(spark, sf_dir)
    pages = F.when(F.col("page").isNotNull(), F.array("page")).otherwise(F.array().cast("array<bigint>")).alias("pages")
    name = lambda stem: F.concat(F.lit(stem), i.cast("string"))
    texts = own.where(i % 8 != 3).select("doc_id", i.alias("place"), F.when(i % 9 != 5, name("t")).alias("item_ref"), pages)
    return texts, own.where(i % 8 == 3).select("doc_id", i.alias("place"), name("b").alias("item_ref"), pages)


@query(f"WITH {_REFS} SELECT doc_id, page, string_agg(item_ref, ' ' ORDER BY kind, place) AS item_refs FROM refs WHERE page IS NOT NULL AND item_ref IS NOT NULL GROUP BY doc_id, page")
def page_item_refs(spark, sf_dir):
    return A.page_map(*_refs(spark, sf_dir)).withColumn("item_refs", F.array_join("item_refs", " "))


@query(f"WITH {_REFS} SELECT doc_id, place FROM refs WHERE kind = 1 AND page IS NOT NULL")
def mapped_tables(spark, sf_dir):
    texts, own = _refs(spark, sf_dir)
    return A.mapped_tables(own, A.page_map(texts, own)).select("doc_id", "place")


@query(f"""WITH {ITEMS}, {_PATHS}, tree AS (SELECT p.doc_id, p.idx, p.level, p.text, titles FROM paths p WHERE p.idx % 16 <> 8)
  SELECT i.doc_id, i.idx, coalesce(t.level, CASE i.label WHEN 'title' THEN 1 WHEN 'page_header' THEN 3 ELSE 2 END)::BIGINT AS level, coalesce(array_to_string(list_append(t.titles, t.text), ' > '), trim(i.text)) AS path, i.page
  FROM items i LEFT JOIN tree t USING (doc_id, idx) WHERE t.idx IS NOT NULL OR i.label <> 'text'""")
def heading_events(spark, sf_dir):
    """Headings by the tree, of which some are missing, or else by their labels."""
    own = items(spark, sf_dir).withColumns({"item_ref": F.col("idx").cast("string"), "pages": F.array("page")})
    tree = paths_of(spark, sf_dir).where("idx % 16 <> 8").select("doc_id", "idx", F.col("idx").cast("string").alias("item_ref"), F.col("text").alias("title"), "level", "path", F.col("parent_idx").cast("string").alias("parent_ref"), F.lit(None).cast("long").alias("page"))
    return A.heading_events(own, tree).select("doc_id", "idx", F.col("level").cast("long").alias("level"), F.array_join("path", " > ").alias("path"), "page")
