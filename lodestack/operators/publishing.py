"""Pages of knowledge: topics, sources, notes, staging, validation and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.functions import strings as S

# Topics in order, with their types of sections and records, and the folder of their pages.
TOPICS = {
    "startup_procedure": (("startup",), ("procedure",), "workflow-guidance"),
    "shutdown_procedure": (("shutdown",), ("procedure",), "workflow-guidance"),
    "maintenance_procedure": (("maintenance",), ("procedure",), "workflow-guidance"),
    "alarm_reference": (("troubleshooting", "other"), ("alarm_definition",), "fault-code"),
    "specifications": (("specifications", "other"), ("spec_value",), "controller"),
    "troubleshooting": (("troubleshooting", "other"), ("troubleshooting_entry",), "symptom"),
}
OTHER_CONFIDENCE = 0.8


def topic(section_type: Column, record_type: Column, confidence: Column, reviewable: Column) -> Column:
    """The first topic of a record, or null. Records of ``other`` sections need confidence and a title that can be trusted."""
    out = F.when((section_type == "other") & (~reviewable | (confidence < OTHER_CONFIDENCE)), F.lit(None).cast("string"))
    for name, (sections, records, _) in TOPICS.items():
        out = out.when(section_type.isin(*sections) & record_type.isin(*records), name)
    return out


def page_label(first: Column, last: Column) -> Column:
    """p.N for one page, pp.N-M for several, null without both."""
    return F.when(first.isNull() | last.isNull(), None).when(first == last, F.concat(F.lit("p."), first)).otherwise(F.concat(F.lit("pp."), first, F.lit("-"), last))


def table_markdown(data: Column) -> Column:
    """Rows of cells as a Markdown table: the first is the head, rows are padded, one blank row if there is no other.

    Cells lose white space at their ends; a cell without a value reads None.
    """
    data = F.transform(data, lambda row: F.transform(row, lambda cell: F.coalesce(S.strip(cell), F.lit("None"))))
    width = F.array_max(F.transform(data, F.size))
    padded = F.transform(data, lambda row: F.concat(row, F.array_repeat(F.lit(""), width - F.size(row))))
    line = lambda row: F.concat(F.lit("| "), F.array_join(row, " | "), F.lit(" |"))
    body = F.when(F.size(data) > 1, F.slice(padded, 2, F.greatest(F.size(data) - 1, F.lit(1)))).otherwise(F.array(F.array_repeat(F.lit(""), width)))
    rule = line(F.array_repeat(F.lit("---"), width))
    return F.when(F.coalesce(width, F.lit(0)) > 0, F.array_join(F.concat(F.array(line(F.element_at(padded, 1)), rule), F.transform(body, line)), "\n")).otherwise("")


def stage(pages: DataFrame) -> DataFrame:
    """pages (kind, topic, slug) with the path they are published under; overview pages aren't."""
    folder = F.when(F.lit(False), F.lit(""))
    for name, (_, _, where) in TOPICS.items():
        folder = folder.when((F.col("kind") == "topic") & (F.col("topic") == name), where)
    folder = folder.when(F.col("kind") == "source", "source-index").when(F.col("kind") == "contradiction", "contradictions")
    return pages.withColumn("path", F.concat_ws("/", F.lit("publish"), folder, F.concat("slug", F.lit(".md")))).where(folder.isNotNull())


def validate(pages: DataFrame) -> DataFrame:
    """pages (path, identity, fields, title, slug) with errors: fields that are missing, slugs that don't fit, identities used before."""
    required = F.array(*map(F.lit, ("title", "type", "status", "generated_by")))
    firsts = pages.where(F.col("identity").isNotNull()).groupBy("identity").agg(F.min("path").alias("first_path"))
    joined = pages.join(firsts, "identity", "left")
    missing = F.array_sort(F.array_except(required, F.col("fields")))
    errors = F.array_compact(
        F.array(
            F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, "+"))),
            F.when(F.col("slug") != S.slug(F.col("title")), "slug"),
            F.when(F.col("path") != F.col("first_path"), F.concat(F.lit("duplicate:"), "first_path")),
        )
    )
    return joined.withColumn("errors", errors)


def diff(staged: DataFrame, target: DataFrame, listed: DataFrame) -> DataFrame:
    """path and change: added, updated (by digest), unchanged, or removed (only files that an earlier manifest lists)."""
    a = staged.select("path", F.col("digest").alias("new"))
    b = target.select("path", F.col("digest").alias("old"))
    known = listed.select("path").distinct().withColumn("listed", F.lit(True))
    both = a.join(b, "path", "full_outer").join(known, "path", "left")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), F.when(F.col("listed"), "removed")).when(F.col("new") != F.col("old"), "updated").otherwise("unchanged")
    return both.withColumn("change", change).where(F.col("change").isNotNull()).select("path", "change")


# The sections of a page's body, in order, and the folders that files may be published in.
BODY_SECTIONS = ("## Summary", "## Field Guidance", "## Source Citations", "## Related Pages")
FOLDERS = ("controllers", "fault-codes", "symptoms", "workflow-guidance", "contradictions", "supersessions", "source-index", "_manifests", "_sources", "_publish-log")


def body_errors(body: Column) -> Column:
    """What a page's body lacks of BODY_SECTIONS, each a line of its own, and whether all are there but not in order."""
    own = F.concat(F.lit("\n"), body)  # a heading may be the first line
    places = [F.locate(f"\n{name}\n", own) for name in BODY_SECTIONS]
    lacking = F.array_compact(F.array(*[F.when(at == 0, F.lit(f"missing:{name}")) for name, at in zip(BODY_SECTIONS, places, strict=True)]))
    ordered = F.array(*places) == F.array_sort(F.array(*places))
    return F.when(F.size(lacking) > 0, lacking).when(~ordered, F.array(F.lit("order"))).otherwise(lacking)


def manifest_errors(listed: DataFrame, before: DataFrame) -> DataFrame:
    """Errors of published manifests (manifest, change, path): paths that are absolute, that climb, or that lead to no known folder, and removals of what was never published (before: path)."""
    parts = F.split("path", "/")
    wrong = (
        F.when(F.startswith("path", F.lit("/")), "absolute")
        .when(F.array_contains(parts, ".."), "climbs")
        .when(~F.get(F.filter(parts, lambda x: (x != "") & (x != ".")), F.lit(0)).isin(*FOLDERS), "folder")
    )
    odd = listed.select("manifest", "path", wrong.alias("error")).where("error IS NOT NULL")
    orphans = listed.where("change = 'removed'").join(before.select("path").distinct(), "path", "left_anti").select("manifest", "path", F.lit("orphan").alias("error"))
    return odd.unionByName(orphans)


CITATION = "[Source:"  # a fixed value


def cited_lines(texts: DataFrame) -> DataFrame:
    """Of texts (doc_id, text) the lines that cite a source, in order: doc_id, place, line.

    A line that starts with a citation ends the line before it; a line without one stays only if such a line follows.
    """
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "raw")).where(F.trim("raw") != "")
    w = Window.partitionBy("doc_id").orderBy("idx")
    own = lines.withColumn("tail", F.startswith(F.trim("raw"), F.lit(CITATION)))
    own = own.withColumns({"first": F.row_number().over(w) == 1, "followed": F.coalesce(F.lead("tail").over(w), F.lit(False))})
    heads = (~F.col("tail") | F.col("first")) & (F.contains("raw", F.lit(CITATION)) | F.col("followed"))
    kept = own.withColumn("head", heads).where("head OR tail").withColumn("place", F.sum(F.when(F.col("head"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("idx", F.when(F.col("head"), F.rtrim("raw")).otherwise(F.trim("raw")).alias("part"))))
    return kept.groupBy("doc_id", "place").agg(F.array_join(F.transform(parts, lambda p: p["part"]), " ").alias("line"))


def low_confidence(records: DataFrame, flags: DataFrame, key: str, usual: float = 0.75) -> DataFrame:
    """records under their key's threshold: the least positive min_confidence of its flags, or the usual one."""
    limits = flags.where("min_confidence > 0").groupBy(key).agg(F.min("min_confidence").alias("limit"))
    return records.join(limits, key, "left").where(F.col("confidence") < F.coalesce("limit", F.lit(usual))).drop("limit")


def notes_of_records(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates (claim_id) whose claim is one of the records (record_id) or a part of one, by equality of the id's head."""
    return candidates.withColumn("record_id", F.substring_index("claim_id", "::", 1)).join(records.select("record_id").distinct(), "record_id", "left_semi")


def tags(manufacturer: Column, family: Column, digest_type: Column) -> Column:
    own = F.array(S.slug(manufacturer), S.slug(family), digest_type, F.when(digest_type == "controller", "controller-family"))
    return F.array_sort(F.array_distinct(F.array_compact(own)))


def first_sources(rows: DataFrame, order: str) -> DataFrame:
    """The first row of each (doc_id, locator)."""
    return rows.groupBy("doc_id", "locator").agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
