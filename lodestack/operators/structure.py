"""From raw items to headings, pages, sections, steps and quality scores.

All windows are partitioned by document, so their groups are as large as one document.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.functions import keywords
from lodestack.functions import strings as S
from lodestack.functions import vocabulary as V


def _by_document(upto: int | None = None):
    w = Window.partitionBy("doc_id").orderBy("idx")
    return w if upto is None else w.rowsBetween(Window.unboundedPreceding, upto)


def infer_pages(items: DataFrame, page_count: Column) -> DataFrame:
    """items with ``page`` filled forward, then backward, then in proportion to their place."""
    forward = F.last("page", ignorenulls=True).over(_by_document(0))
    back = F.first("page", ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("idx").rowsBetween(0, Window.unboundedFollowing))
    n = F.count(F.lit(1)).over(Window.partitionBy("doc_id"))
    p = F.greatest(F.lit(1), page_count)
    place = F.least(p, F.floor((F.row_number().over(_by_document()) - 1) * p / n) + 1)
    return items.withColumn("page", F.coalesce(forward, back, place).cast("long"))


# Fixed value: the number that a title may start with.
NUMBER = r"^(?:step\s+)?\d+(?:\.\d+)*[).:\-]?\s*"


def number_stripped(normal: Column) -> Column:
    """A normalized title without the number that it starts with, once."""
    return F.trim(F.regexp_replace(normal, NUMBER, ""))


# Titles that decide nothing by their section's content.
NEUTRAL_TITLES = (
    "", "about this publication", "additional resources", "application technique", "continued", "details", "general", "guidance", "how are we doing", "instructions", "introduction", "notes",
    "overview", "related documentation", "related publications", "using this appendix", "using this chapter", "what to do next", "who should use this manual",
)
# First words of titles that describe doing something.
PROCEDURAL_STARTS = (
    "add ", "adding ", "assign ", "change ", "changing ", "choose ", "click ", "complete ", "configure ", "configuring ", "connect ", "connecting ", "create ", "creating ", "define ",
    "determining ", "disable ", "download ", "downloading ", "enable ", "enter ", "identify ", "install ", "mount ", "monitoring ", "remove ", "replace ", "restore ", "route ", "select ",
    "set up ", "setup ", "specify ", "verify ", "view ", "wire ", "accessing ", "communicating ", "documenting ", "example ", "placing ", "proceed ",
)


def classify(df: DataFrame) -> DataFrame:
    """df (title, content, document_type, document_class, maybe parents) with section_type.

    It is told by the title, the parents' titles, the document's type, the content, or the title's form. Texts are read
    once for the keywords of all contexts; the content is made ready only where the document's type leaves it open.
    """
    plain, kind = S.classifier_text(F.col("title")), S.slug(F.col("document_type"))
    prepared = df.withColumns({"_plain": plain, "_kind": kind}).withColumn("_short", number_stripped(F.col("_plain")))
    plain, short, kind = F.col("_plain"), F.col("_short"), F.col("_kind")
    context = (
        F.when(kind.isin(*V.CONTEXT_TYPES["operational"]) | (S.strip(S.fold(F.col("document_class"))) == "operational"), "operational")
        .when(kind.isin(*V.CONTEXT_TYPES["drawing"]), "drawing")
        .when(kind.isin(*V.CONTEXT_TYPES["bulletin"]), "bulletin")
        .otherwise("manual")
    )
    usual = F.create_map(*[F.lit(x) for item in V.DEFAULT_SECTION_TYPES.items() for x in item])
    by_kind = F.when(~plain.isin("overview", "notes", "instructions"), F.try_element_at(usual, kind))
    starts = short.rlike("^(?:" + "|".join(PROCEDURAL_STARTS) + ")")
    few = F.size(F.array_remove(F.split(short, " "), "")) <= 4
    look = ~plain.isin(*NEUTRAL_TITLES) & (plain.rlike(NUMBER) | starts | plain.isin(*V.ADMONITIONS) | ((plain != short) & (short != "")) | (few & ~short.isin(*NEUTRAL_TITLES)))
    safe = plain.isin(*V.ADMONITIONS) | short.isin(*V.ADMONITIONS)
    above = S.classifier_text(F.col("parents")) if "parents" in df.columns else F.lit("")
    inside = F.when(~safe & by_kind.isNull() & look, S.classifier_text(F.substring("content", 1, 500)))
    told = keywords.section_type(context, F.when(~safe, F.concat_ws("\n", plain, short)), F.when(~safe, above), F.when(~safe, by_kind), inside)
    by_form = F.when(S.strip(F.col("title")).rlike("(?i)" + NUMBER) | starts, "workflow")
    return prepared.withColumn("section_type", F.coalesce(F.when(safe, "safety"), told, by_form, F.lit("other"))).select(*df.columns, "section_type")


def reviewability(title: Column) -> Column:
    """The reasons not to trust a section's title, sorted; empty if there are none. Patterns and bounds are fixed values."""
    t = S.collapse(F.coalesce(title, F.lit("")))
    refs = F.size(F.regexp_extract_all(t, F.lit(r"(?i)((?:\b[A-Z]-\d+\b|\b\d+-\d+\b|\b\d+\b))")))
    words = F.size(F.split(t, " "))
    reasons = F.array(
        F.when(t.rlike("^[A-Za-z]$"), "single_letter_title"),
        F.when(t.rlike(r"^(?:\d+|(?:\d+\.)+|\d+\.)$"), "numeric_fragment_title"),
        F.when(S.fold(t).isin(*V.CARRYOVER_TITLES), "generic_carryover_title"),
        F.when((F.length(t) >= 80) & (words >= 12) & (refs >= 6), "toc_fragment_title"),
    )
    return F.when(t == "", F.array(F.lit("empty_title"))).otherwise(F.array_sort(F.array_compact(reasons)))


def section_id(doc_id: Column, title: Column, content: Column) -> Column:
    own = F.concat_ws("\n", doc_id, S.strip(title), S.strip(content))
    return F.concat_ws("--", doc_id, F.substring(S.slug(title), 1, 80), S.digest(own, 12))


def ocr_decision(has_text: Column, has_vector: Column, density: Column, page_count: Column, bypassed: Column, threshold: float = 50.0, target: float = 200.0, large: int = 25) -> Column:
    """What to do with a page: ``bypass`` (by type), ``vector``, ``ocr`` or ``keep``. Pages with text of large documents count as dense."""
    dense = F.when(has_text & (page_count >= large), F.lit(max(threshold, target))).otherwise(density)
    return F.when(bypassed, "bypass").when(has_vector & ~has_text, "vector").when(~has_text | (dense < threshold), "ocr").otherwise("keep")


def visible_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"(?U)\s", ""))


def text_density(chars: Column, width: Column, height: Column) -> Column:
    """Visible characters for each square inch of a page, which counts as one at least."""
    return chars / F.greatest(width * height, F.lit(1.0))


def ocr_confidence(density: Column, target: float) -> Column:
    return F.lit(1.0) if target <= 0 else F.round(F.least(density / target, F.lit(1.0)), 3)


def quality(df: DataFrame) -> DataFrame:
    """Scores (percent) and their weighted sum, from counts per document.

    Needs: headings, candidates, tables, good_tables, markdown_chars, text_chars, depth, min_level, max_level, mapped_pages, page_count.
    """
    scored = (
        df.withColumn("heading_coverage", F.when(F.col("candidates") == 0, F.when(F.col("headings") == 0, 100.0).otherwise(0.0)).otherwise(F.least(F.try_divide("headings", "candidates"), F.lit(1.0)) * 100))
        .withColumn("table_rate", F.when(F.col("tables") == 0, 100.0).otherwise(F.try_divide("good_tables", "tables") * 100))
        .withColumn("text_completeness", F.when(F.col("text_chars") == 0, 0.0).otherwise(F.least(F.try_divide("markdown_chars", "text_chars"), F.lit(1.0)) * 100))
        .withColumn("structure_depth", F.when(F.col("headings") == 0, 0.0).otherwise((F.least(F.col("depth") / 3, F.lit(1.0)) * 0.6 + F.least((F.col("max_level") - F.col("min_level") + 1) / 3, F.lit(1.0)) * 0.4) * 100))
        .withColumn("page_coverage", F.when(F.col("page_count") == 0, 0.0).otherwise(F.least(F.try_divide("mapped_pages", "page_count"), F.lit(1.0)) * 100))
    )
    overall = F.col("heading_coverage") * 0.25 + F.col("table_rate") * 0.2 + F.col("text_completeness") * 0.25 + F.col("structure_depth") * 0.15 + F.col("page_coverage") * 0.15
    return scored.withColumn("overall", F.round(overall, 2))


def markdown_items(docs: DataFrame) -> DataFrame:
    """Items of Markdown texts (doc_id, text): paragraphs between blank lines, headings by their marks, in order."""
    parts = F.filter(F.split("text", r"\n[ \t]*\n"), lambda p: F.length(F.trim(p)) > 0)
    rows = docs.select("doc_id", F.posexplode(parts).alias("idx", "raw"))
    body = S.strip(F.col("raw"))
    marks = F.regexp_extract(body, r"^(#{1,6})\s+\S", 1)
    return rows.select(
        "doc_id",
        F.col("idx").cast("long"),
        F.when(marks != "", "section_header").otherwise("text").alias("label"),
        F.when(marks != "", F.regexp_replace(body, r"^#{1,6}\s+", "")).otherwise(body).alias("text"),
        F.when(marks != "", F.length(marks)).alias("level"),
    )


def with_provenance(procedures: DataFrame, provenance: Column) -> DataFrame:
    """procedures with the same provenance on the record, its steps and its warnings, whatever they had before."""
    put = lambda x: x.withField("provenance", provenance)
    return procedures.withColumn("provenance", provenance).withColumn("steps", F.transform("steps", put)).withColumn("warnings", F.transform("warnings", put))
