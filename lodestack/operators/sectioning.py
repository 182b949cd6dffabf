"""Sections of documents: boundaries, paths, content, tables, steps and figure regions.

Items are rows (doc_id, idx, label, text, level, page); level is null for what is no heading. Tables are
rows (doc_id, table_no, page, data). All windows and groups are one document's, or one section's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.functions import strings as S
from lodestack.operators.publishing import table_markdown

# Labels of headings, of titles, and of headings that open no section.
HEADING_LABELS = ("document_title", "page_header", "section_header", "section_title", "subtitle", "title")
TITLE_LABELS = ("title", "document_title")
EXEMPT_LABELS = ("title", "document_title", "page_header", "page_footer", "running_header", "running_footer")
# Heading levels by label; others are 3.
LABEL_LEVELS = {"title": 1, "document_title": 1, "section_header": 2, "subtitle": 2, "page_header": 3, "section_title": 3}
# Types of sections with steps, and with figure regions.
STEP_TYPES = ("workflow", "sop", "checklist", "inspection", "commissioning", "seasonal-procedure")
FIGURE_TYPES = ("wiring", "drawing", "diagram")
# Patterns of numbered steps, checkboxes, bullets, figure labels and callouts.
STEP = r"(?i)^(?:step\s+)?(\d+)[).:\-]?\s+(.+)$"
CHECKBOX = r"^(?:[-*•]\s+)?\[(?: |x|X)\]\s+(.+)$"
BULLET = r"^(?:[-*•])\s+(.+)$"
FIGURE = r"(?i)^((?:figure|fig\.?|diagram|drawing|wiring diagram|schematic|p&id)[A-Za-z0-9.\- ]*)$"
CALLOUT = r"(?i)^(?:callout\s+)?(?:[A-Z]{1,3}|\d{1,3}|[A-Z]\d{1,2})[).:\-]\s+.+$"


def label_level(label: Column) -> Column:
    """A heading's level by its label, in any case; null for what is no heading."""
    label = S.fold(label)
    levels = F.create_map(*[F.lit(x) for item in LABEL_LEVELS.items() for x in item])
    return F.when(label.isin(*HEADING_LABELS), F.coalesce(F.try_element_at(levels, label), F.lit(3)))


def labelled_headings(items: DataFrame) -> DataFrame:
    """The headings of parsed items (doc_id, idx, label, text), by their labels: doc_id, idx, level and title. Blank ones are none."""
    title = S.strip(F.col("text"))
    return items.select("doc_id", "idx", label_level(F.col("label")).alias("level"), title.alias("text")).where(F.col("level").isNotNull() & (F.col("text") != ""))


def heading_depths(paths: DataFrame) -> DataFrame:
    """doc_id and depth: how deep the headings of ``heading_paths`` stand in one another."""
    return paths.groupBy("doc_id").agg(F.max(F.size("path")).cast("long").alias("depth"))


def heading_paths(headings: DataFrame, levels: int | None = None) -> DataFrame:
    """headings (doc_id, idx, level, text) with parent_idx and path: the titles of the headings it stands under, and its own.

    Levels are 1 or more; if it isn't told, the largest is asked for first. A heading stands under the last earlier one of a smaller level, and so on up. At level k that is the last
    one of level k or less, if it is of level k.
    """
    levels = levels or headings.agg(F.max("level")).first()[0] or 1
    before = Window.partitionBy("doc_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    out, above = headings, []
    for k in range(1, levels):
        last = F.last(F.when(F.col("level") <= k, F.struct("level", "idx", "text")), ignorenulls=True).over(before)
        out = out.withColumn(f"_at{k}", last)
        above.append(F.when((F.col("level") > k) & (F.col(f"_at{k}.level") == k), F.col(f"_at{k}")))
    kept = F.array_compact(F.array(*above)) if above else F.array().cast("array<struct<level:bigint,idx:bigint,text:string>>")
    return out.withColumns({"parent_idx": F.get(kept, F.size(kept) - 1)["idx"], "path": F.concat(F.transform(kept, lambda x: x["text"]), F.array("text"))}).drop(*[f"_at{k}" for k in range(1, levels)])


def numbered(items: DataFrame) -> DataFrame:
    """items with ``opens``, section_no (0 before the first section), and the document's title and whether it has sections."""
    opens = F.col("label").isin(*HEADING_LABELS) & ~F.col("label").isin(*EXEMPT_LABELS)
    whole = Window.partitionBy("doc_id")
    ordered = whole.orderBy("idx")
    title = F.when(F.col("label").isin(*TITLE_LABELS) & (S.strip(F.col("text")) != ""), S.strip(F.col("text")))
    return (
        items.withColumn("opens", opens)
        .withColumn("section_no", F.sum(F.when(F.col("opens"), 1).otherwise(0)).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
        .withColumn("sectioned", F.max("opens").over(whole))
        .withColumn("document_title", F.first(title, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )


def body_items(items: DataFrame) -> DataFrame:
    """The numbered items that make up sections: not their headings, not other headings, not blank ones."""
    return items.where(~F.col("opens") & ~F.col("label").isin(*HEADING_LABELS) & (S.strip(F.col("text")) != ""))


def _bounds(items: DataFrame) -> DataFrame:
    """One row for each section: what its heading says, where its pages start, and where the next section's do."""
    inside = ~F.col("opens")
    first_page = F.min_by("page", F.when(F.col("page").isNotNull() & inside, F.col("idx")))
    rows = items.groupBy("doc_id", "section_no").agg(
        F.first("sectioned").alias("sectioned"),
        F.first("document_title").alias("document_title"),
        F.max(F.when(F.col("opens"), S.strip(F.col("text")))).alias("heading"),
        F.max(F.when(F.col("opens"), F.col("level"))).alias("level"),
        F.max(F.when(F.col("opens"), F.col("idx"))).alias("heading_idx"),
        F.max(F.when(F.col("opens"), F.col("page"))).alias("heading_page"),
        first_page.alias("first_page"),
        F.min(F.when(inside, F.col("page"))).alias("low"),
        F.max(F.when(inside, F.col("page"))).alias("high"),
    )
    ordered = Window.partitionBy("doc_id").orderBy("section_no")
    onward = ordered.rowsBetween(1, Window.unboundedFollowing)
    # After a preamble the first page on which anything of the sections is; else the next heading's page.
    later = F.first(F.coalesce("heading_page", "first_page"), ignorenulls=True).over(onward)
    stop = F.when(F.col("section_no") == 0, later).otherwise(F.lead("heading_page").over(ordered))
    start = F.when(F.col("section_no") == 0, F.lit(1)).otherwise(F.coalesce("heading_page", "first_page", F.lit(1)))
    return rows.withColumns({"start": start, "stop": stop})


def placed_tables(tables: DataFrame, bounds: DataFrame) -> DataFrame:
    """tables with section_no: the first section whose pages take them in. Documents without sections hold all of theirs."""
    own = bounds.select("doc_id", "section_no", "sectioned", "start", "stop")
    inside = F.col("page").isNotNull() & (F.col("start") <= F.col("page")) & (F.col("stop").isNull() | (F.col("page") < F.col("stop")))
    held = tables.join(own, "doc_id").where(~F.col("sectioned") | inside)
    place = held.groupBy("doc_id", "table_no").agg(F.min("section_no").alias("section_no"))
    return tables.join(place, ["doc_id", "table_no"])


def sections(items: DataFrame, tables: DataFrame) -> DataFrame:
    """One row for each section of numbered items: title, level, heading_idx, page_from, page_to and content.

    A document without sections is one, by the document's title or its id; what is before the first section
    is one too (by the document's title, or ``Overview``), unless it has no content.
    """
    keys = ["doc_id", "section_no"]
    bounds = _bounds(items)
    texts = body_items(items).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", S.strip(F.col("text")).alias("own")))).alias("texts"))
    placed = placed_tables(tables, bounds).withColumn("own", table_markdown(F.col("data")))
    tabled = placed.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("own") != "", F.struct("table_no", "own")))).alias("tabled"), F.min("page").alias("table_low"), F.max("page").alias("table_high")
    )
    plain = lambda c: F.coalesce(F.transform(c, lambda x: x["own"]), F.array().cast("array<string>"))
    heading = F.when(F.col("heading") != "", F.array(F.concat(F.lit("## "), F.col("heading")))).otherwise(F.array().cast("array<string>"))
    content = F.array_join(F.concat(heading, plain("texts"), plain("tabled")), "\n\n")
    title = F.when(F.col("section_no") > 0, F.col("heading")).otherwise(F.coalesce("document_title", F.when(~F.col("sectioned"), F.col("doc_id").cast("string")).otherwise("Overview")))
    fallback = F.when(F.col("section_no") > 0, F.col("heading_page"))
    out = bounds.join(texts, keys, "left").join(tabled, keys, "left").select(
        *keys,
        title.alias("title"),
        "level",
        "heading_idx",
        "heading_page",
        "sectioned",
        F.coalesce(F.least("low", "table_low"), fallback).alias("page_from"),
        F.coalesce(F.greatest("high", "table_high"), fallback).alias("page_to"),
        S.strip(content).alias("content"),
    )
    return out.where((F.col("section_no") > 0) | ~F.col("sectioned") | (F.col("content") != "")).drop("sectioned")


def _lines(items: DataFrame, *more: str) -> DataFrame:
    """The lines of body items that aren't blank, stripped, in order (idx, line_no)."""
    rows = body_items(items).select("doc_id", "section_no", "idx", "page", *more, F.posexplode(F.split(S.strip(F.col("text")), r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\u0085  ]")).alias("line_no", "raw"))
    return rows.withColumn("line", S.strip(F.col("raw"))).where("line <> ''").drop("raw")


def steps(items: DataFrame, typed: DataFrame) -> DataFrame:
    """Steps of sections (doc_id, section_no, step_no, body, page) from numbered items and typed sections (section_type, operational).

    Lines with a number, a checkbox, or in checklists a bullet are steps, numbered as they say or else one on from
    the step before. Sections of types with steps that have no such line number all their lines.
    """
    known = typed.select("doc_id", "section_no", "section_type", "operational").where(F.col("section_type").isin(*STEP_TYPES) | F.col("operational"))
    lines = _lines(items).join(known, ["doc_id", "section_no"])
    number = F.regexp_extract("line", STEP, 1)
    is_number, is_box = F.col("line").rlike(STEP), F.col("line").rlike(CHECKBOX)
    is_bullet = (F.col("section_type") == "checklist") & F.col("line").rlike(BULLET)
    body = F.when(is_number, F.regexp_extract("line", STEP, 2)).when(is_box, F.regexp_extract("line", CHECKBOX, 1)).when(is_bullet, F.regexp_extract("line", BULLET, 1))
    whole = number.try_cast("long")  # null beyond 64 bits
    given = F.when(is_number & (whole > 0), whole)
    section = Window.partitionBy("doc_id", "section_no")
    parsed = lines.withColumns({"body": S.strip(body), "given": given}).withColumn("any", F.max(F.col("body").isNotNull()).over(section))
    kept = parsed.where(F.col("body").isNotNull() | (~F.col("any") & F.col("section_type").isin(*STEP_TYPES)))
    ordered = section.orderBy("idx", "line_no")
    runs = kept.withColumn("run", F.count("given").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy("doc_id", "section_no", "run").orderBy("idx", "line_no")
    first = F.coalesce(F.first("given").over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.lit(1).cast("long"))
    place = F.row_number().over(ordered).cast("long")
    return runs.select("doc_id", "section_no", place.alias("place"), (first + F.row_number().over(inside) - 1).alias("step_no"), F.coalesce("body", "line").alias("body"), "page")


def figure_regions(items: DataFrame, typed: DataFrame) -> DataFrame:
    """Figure regions of sections that are drawings: doc_id, section_no, region, label, page and callouts.

    A line that is a figure's label opens a region; lines before the first one are in a region by the section's title.
    """
    known = typed.select("doc_id", "section_no", "section_type", "title").where(F.col("section_type").isin(*FIGURE_TYPES))
    lines = _lines(items).join(known, ["doc_id", "section_no"]).withColumn("opens_region", F.col("line").rlike(FIGURE))
    ordered = Window.partitionBy("doc_id", "section_no").orderBy("idx", "line_no")
    placed = lines.withColumn("region", F.sum(F.when(F.col("opens_region"), 1).otherwise(0)).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    callout = F.when(~F.col("opens_region") & F.col("line").rlike(CALLOUT), F.struct("idx", "line_no", "line"))
    return placed.groupBy("doc_id", "section_no", "region").agg(
        F.coalesce(F.max(F.when(F.col("opens_region"), S.strip(F.col("line")))), F.first("title")).alias("label"),
        F.min_by("page", F.struct("idx", "line_no")).alias("page"),
        F.transform(F.array_sort(F.collect_list(callout)), lambda x: x["line"]).alias("callouts"),
    )


def fallback_headings(items: DataFrame) -> DataFrame:
    """Headings by the fallback parser's rule: titles are of level 1, section headers of level 2, others none.

    A document without any gets one title: its first line that isn't blank, cut to 120 characters.
    """
    level = F.when(F.col("label") == "title", 1).when(F.col("label") == "section_header", 2)
    text = S.strip(F.col("text"))
    found = items.withColumn("own", F.when(text != "", level)).withColumn("title", text)
    any_heading = F.max(F.col("own").isNotNull()).over(Window.partitionBy("doc_id"))
    first = F.min(F.when(text != "", F.col("idx"))).over(Window.partitionBy("doc_id"))
    marked = found.withColumns({"some": any_heading, "first": first}).where(F.col("own").isNotNull() | (~F.col("some") & (F.col("idx") == F.col("first"))))
    line = F.substring(S.strip(F.element_at(F.split("title", "\n"), 1)), 1, 120)
    return marked.select("doc_id", "idx", F.coalesce("own", F.lit(1)).alias("level"), F.when(F.col("own").isNull(), line).otherwise(F.col("title")).alias("title"))


def fallback_pages(counts: DataFrame) -> DataFrame:
    """Pages 1 to n of documents (doc_id, page_count); none for 0."""
    return counts.where("page_count > 0").select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("page_count").cast("long"))).alias("page"))


def page_count(listed: Column, told: Column) -> Column:
    """A document's pages: as many as are listed, else as the parser tells, else 0."""
    return F.coalesce(F.when(listed > 0, listed), F.when(told > 0, told), F.lit(0)).cast("long")


def page_map(texts: DataFrame, tables: DataFrame) -> DataFrame:
    """doc_id, page, item_refs: the items and tables (doc_id, item_ref, place, pages) on each page, in order; those without pages are left out."""
    rows = texts.select("doc_id", F.lit(0).alias("kind"), "place", "item_ref", F.explode("pages").alias("page")).unionByName(tables.select("doc_id", F.lit(1).alias("kind"), "place", "item_ref", F.explode("pages").alias("page")))
    refs = F.array_sort(F.collect_list(F.struct("kind", "place", "item_ref")))
    return rows.where("item_ref IS NOT NULL").groupBy("doc_id", "page").agg(F.transform(refs, lambda x: x["item_ref"]).alias("item_refs"))


def mapped_tables(tables: DataFrame, pages: DataFrame) -> DataFrame:
    """tables whose item_ref is on some page of the map."""
    refs = pages.select("doc_id", F.explode("item_refs").alias("item_ref")).distinct()
    return tables.where("item_ref IS NOT NULL").join(refs, ["doc_id", "item_ref"], "left_semi")


def heading_events(items: DataFrame, headings: DataFrame) -> DataFrame:
    """Items that are headings: by the tree (item_ref, title, level, path, page), or else by their label, with their own title as path.

    headings: doc_id, item_ref, title, level, path, parent_ref, page. Of equal refs the last counts.
    """
    tree = headings.groupBy("doc_id", "item_ref").agg(F.max_by(F.struct("title", "level", "path", "parent_ref", "page"), "idx").alias("h"))
    met = items.join(tree, ["doc_id", "item_ref"], "left").where(F.col("h").isNotNull() | F.col("label").isin(*HEADING_LABELS))
    own = S.strip(F.col("text"))
    return met.select(
        "doc_id",
        "idx",
        "item_ref",
        "label",
        F.coalesce("h.title", own).alias("title"),
        F.coalesce("h.level", label_level(F.col("label"))).alias("level"),
        F.coalesce("h.path", F.array(own)).alias("path"),
        F.col("h.parent_ref").alias("parent_ref"),
        F.coalesce("h.page", F.get("pages", F.lit(0))).alias("page"),
    )
