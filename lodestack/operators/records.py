"""Extracted records: their claims, the buckets they count in, their numbers, and what is stale."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.functions import strings as S
from lodestack.operators.ranking import placed


def _lower_list(x: Column) -> Column:
    return F.transform(x, S.fold)


def scope(own: Column, document: Column) -> Column:
    """Where a claim applies: what the record says (manufacturer, family, models, revision), or else its document."""
    chosen = F.coalesce(own, document)
    return F.struct(S.fold(chosen["manufacturer"]).alias("manufacturer"), S.fold(chosen["family"]).alias("family"), _lower_list(chosen["models"]).alias("models"), chosen["revision"].alias("revision"))


def _claims(rows: DataFrame, record_id: Column, kind: str, subject: Column, label: Column, text: Column, signature: Column, where: Column) -> DataFrame:
    return rows.select(record_id.alias("record_id"), "doc_id", F.lit(kind).alias("claim_type"), subject.alias("subject"), label.alias("subject_label"), text.alias("claim_text"), signature.alias("signature"), where.alias("scope"))


def claims_of_records(records: DataFrame) -> DataFrame:
    """One claim for each value, alarm and warning, and one for each step and warning of a procedure. Other records make none.

    Values and alarms apply where their document does; warnings and procedures where they say themselves, if they do.

    records: doc_id, record_id, record_type, title, applicability, document (structs of a scope), and the fields of
    the types: parameter, value, unit, conditions; code, description, cause, remedy, severity; context, source_heading,
    text; steps (step_number, instruction) and warnings (severity, text, context, applicability).
    """
    c = F.col
    of_document = scope(c("document"), c("document"))
    plain = scope(c("applicability"), c("document"))
    number = lambda x: F.lpad(x.cast("string"), 3, "0")
    some = lambda x: x.isNotNull() & (x != "")
    of = lambda kind: records.where(c("record_type") == kind)

    unit = F.when(some(c("unit")), F.concat(F.lit(" "), c("unit"))).otherwise("")
    conditions = F.when(some(c("conditions")), F.concat(F.lit(" ("), c("conditions"), F.lit(")"))).otherwise("")
    parts = F.filter(F.array(*[S.fold(F.coalesce(c(x), F.lit(""))) for x in ("value", "unit", "conditions")]), lambda x: x != "")
    values = _claims(of("spec_value"), c("record_id"), "spec_value", S.slug(c("parameter")), c("parameter"), F.concat(c("parameter"), F.lit(": "), c("value"), unit, conditions), F.array_join(parts, "|"), of_document)

    alarm_text = F.concat(c("description"), F.lit("; cause "), c("cause"), F.lit("; remedy "), c("remedy"), F.lit("; severity "), c("severity"))
    alarms = _claims(of("alarm_definition"), c("record_id"), "alarm_definition", S.fold(c("code")), c("code"), alarm_text, F.concat_ws("|", *[S.fold(c(x)) for x in ("description", "cause", "remedy", "severity")]), of_document)

    def warned(rows: DataFrame, record_id: Column, severity: Column, text: Column, about: Column, where: Column) -> DataFrame:
        return _claims(rows, record_id, "warning", S.slug(about), about, F.concat(severity, F.lit(": "), text), F.concat_ws("|", S.fold(severity), S.fold(text)), where)

    about = F.when(some(c("context")), c("context")).otherwise(c("source_heading"))
    warnings = warned(of("warning"), c("record_id"), c("severity"), c("text"), about, plain)

    step = of("procedure").withColumn("s", F.explode("steps"))
    own_number = number(c("s.step_number"))
    steps = _claims(
        step,
        F.concat("record_id", F.lit("::step-"), own_number),
        "procedure_step",
        F.concat(S.slug(c("title")), F.lit("::step-"), own_number),
        F.concat("title", F.lit(" step "), c("s.step_number").cast("string")),
        c("s.instruction"),
        S.fold(c("s.instruction")),
        plain,
    )
    inner = of("procedure").select("*", F.posexplode("warnings").alias("i", "w"))
    inner_about = F.when(some(c("w.context")), c("w.context")).otherwise(c("title"))
    nested = warned(inner, F.concat("record_id", F.lit("::warning-"), number(c("i") + 1)), c("w.severity"), c("w.text"), inner_about, scope(F.coalesce(c("w.applicability"), c("applicability")), c("document")))
    return reduce(DataFrame.unionByName, (values, alarms, warnings, steps, nested))


def bucket_records(records: DataFrame, assignments: DataFrame, buckets: Column) -> DataFrame:
    """records with bucket_id, for each of the buckets that both their document (assignments: doc_id, bucket_id) and they themselves are in."""
    own = records.withColumn("bucket_id", F.explode(F.array_distinct(buckets)))
    return own.join(assignments.select("doc_id", "bucket_id").distinct(), ["doc_id", "bucket_id"], "left_semi")


def in_claim_order(claims: DataFrame) -> DataFrame:
    """claims with place, their number in the order by type, subject, document and record, in each bucket."""
    return placed(claims, ["bucket_id"], ["claim_type", "subject", "doc_id", "record_id"])


def first_of_pairs(pairs: DataFrame) -> DataFrame:
    """One row for each unordered pair (a_id, b_id) of a bucket: pairs are seen once."""
    ordered = pairs.withColumns({"low": F.least("a_id", "b_id"), "high": F.greatest("a_id", "b_id")})
    return ordered.groupBy("bucket_id", "low", "high").agg(F.count(F.lit(1)).alias("seen")).select("bucket_id", F.col("low").alias("a_id"), F.col("high").alias("b_id"))


def note_order(candidates: DataFrame) -> DataFrame:
    """candidates (bucket_id, a_id, b_id, a_subject) with place, their number in the order of notes, in each bucket."""
    return placed(candidates, ["bucket_id"], [S.fold(F.col("a_subject")), "a_id", "b_id"])


def note_entries(candidates: DataFrame, claims: DataFrame) -> DataFrame:
    """candidates (bucket_id, a_id, b_id) with both claims' subjects and texts, in the order of notes; those that lack a claim go.

    Texts join after places are known, so what is sorted and written for these has none.
    """
    side = lambda p, name, own: claims.select("bucket_id", F.col("record_id").alias(f"{p}_id"), F.col(own).alias(f"{p}_{name}"))
    both = lambda df, *named: df.join(side("a", *named), ["bucket_id", "a_id"]).join(side("b", *named), ["bucket_id", "b_id"])
    return both(note_order(both(candidates, "subject", "subject_label")), "text", "claim_text")


def section_of_record(record_id: Column) -> Column:
    """A record's section: its id without the last two parts (type and number)."""
    return F.regexp_extract(record_id, r"^(.*?)(?:--(?:(?!--).)*)?(?:--(?:(?!--).)*)?$", 1)


def records_with_sections(records: DataFrame, sections: DataFrame) -> DataFrame:
    """records beside their sections (section_id); those without one go."""
    return records.withColumn("section_id", section_of_record(F.col("record_id"))).join(sections, "section_id")


def missing_sections(requested: DataFrame, sections: DataFrame) -> DataFrame:
    """The sections (doc_id, section_id) that a run is asked for and that there aren't: it doesn't start with any."""
    return requested.select("doc_id", "section_id").distinct().join(sections.select("doc_id", "section_id"), ["doc_id", "section_id"], "left_anti")


def counts_by_section(records: DataFrame, sections: DataFrame) -> DataFrame:
    """Records of each section, 0 for sections without; and of sections that only records know."""
    held = records.groupBy(section_of_record(F.col("record_id")).alias("section_id")).agg(F.count(F.lit(1)).alias("n"))
    return sections.select("section_id").distinct().join(held, "section_id", "full_outer").select("section_id", F.coalesce("n", F.lit(0)).cast("long").alias("records"))


def numbered_records(records: DataFrame) -> DataFrame:
    """records (section_id, record_type, ordinal) with record_id: section, type and a number from 001 in each."""
    w = Window.partitionBy("section_id", "record_type").orderBy("ordinal")
    return records.withColumn("record_id", F.concat_ws("--", "section_id", "record_type", F.lpad(F.row_number().over(w).cast("string"), 3, "0")))


def stale_records(existing: DataFrame, written: DataFrame) -> DataFrame:
    """Existing records of sections and types that were written anew and that aren't among those written. Others aren't stale."""
    touched = written.select("section_id", "record_type").distinct()
    return existing.join(touched, ["section_id", "record_type"], "left_semi").join(written.select("record_id"), "record_id", "left_anti")


def discovered_buckets(assignments: DataFrame, extracted: DataFrame) -> DataFrame:
    """The buckets of documents (doc_id) for which something was extracted, records or review flags."""
    return assignments.join(extracted.select("doc_id").distinct(), "doc_id", "left_semi").select("bucket_id").distinct()


def queue_metrics(items: DataFrame, key: str) -> DataFrame:
    """Tokens of items that are pending or in progress, and the number of items, for each key."""
    waiting = F.col("status").isin("pending", "in_progress")
    return items.groupBy(key).agg(F.coalesce(F.sum(F.when(waiting, F.col("tokens"))), F.lit(0)).cast("long").alias("tokens_queued"), F.count(F.lit(1)).alias("items"))


def batch_stats(outcomes: DataFrame, key: str, buckets: int = 64) -> tuple[DataFrame, DataFrame]:
    """Of outcomes (custom_id, outcome, retriable): totals of each key's batch, and the rows to try again."""
    stats = outcomes.groupBy(key).agg(
        F.count(F.when(F.col("outcome") != "missing", 1)).alias("total"), F.count(F.when(F.col("outcome") == "succeeded", 1)).alias("succeeded"), F.count(F.when(F.col("outcome") == "failed", 1)).alias("failed")
    )
    return stats, outcomes.where((F.col("outcome") == "failed") & F.col("retriable")).select(key, "custom_id")


def next_run_id(runs: DataFrame, day: Column) -> DataFrame:
    """run_id of the next run of each day: er-YYYYMMDD-NNN, one more than the greatest of the day's ids (run_id)."""
    stem = F.concat(F.lit("er-"), F.date_format(day, "yyyyMMdd"), F.lit("-"))
    number = F.when(F.startswith("run_id", stem), F.expr("try_cast(substring_index(run_id, '-', -1) AS BIGINT)"))
    return runs.groupBy(stem.alias("stem")).agg(F.max(number).alias("last")).select(F.concat("stem", F.lpad((F.coalesce("last", F.lit(0)) + 1).cast("string"), 3, "0")).alias("run_id"))


def single_or(values: Column, fallback: Column, several: Column | None = None) -> Column:
    """The one value of a sorted list without blanks, the fallback if it is empty, and ``several`` (or the fallback) if there are more."""
    kept = F.array_sort(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (S.strip(x) != ""))))
    return F.when(F.size(kept) == 0, fallback).when(F.size(kept) == 1, F.element_at(kept, 1)).otherwise(fallback if several is None else several)


def applicability_text(own: Column) -> Column:
    """manufacturer family; models; and, if there are any, revision and serial range, in one line; null for none."""
    some = lambda name, label: F.when(own[name].isNotNull() & (own[name] != ""), F.concat(F.lit(label), own[name]))
    line = F.concat_ws("; ", F.concat(own["manufacturer"], F.lit(" "), own["family"]), F.concat(F.lit("models: "), F.array_join(own["models"], ", ")), some("revision", "revision: "), some("serial_range", "serial range: "))
    return F.when(own.isNotNull(), line)


def page_range_label(first: Column, last: Column) -> Column:
    """p.N, pp.N-M, from p.N, through p.N, or pages unknown."""
    return (
        F.when(first.isNull() & last.isNull(), "pages unknown")
        .when(first == last, F.concat(F.lit("p."), first))
        .when(first.isNull(), F.concat(F.lit("through p."), last))
        .when(last.isNull(), F.concat(F.lit("from p."), first))
        .otherwise(F.concat(F.lit("pp."), first, F.lit("-"), last))
    )


def utc_stamp(ts: Column) -> Column:
    """An ISO timestamp in UTC with Z, without parts of a second. The session's time zone is UTC."""
    return F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON with keys in order at every depth; null fields are kept."""
    plain = F.to_json(F.struct(*[own.alias(name) for name, own in sorted(fields.items())]), {"ignoreNullFields": "false"})
    return F.to_json(F.parse_json(plain))  # the keys of a VARIANT's objects are in order


def written_or_updated(written: DataFrame, updated: DataFrame) -> DataFrame:
    return written.select("path").union(updated.select("path")).distinct()


def review_flags(records: DataFrame, unit: str, least: float) -> DataFrame:
    """For each unit with records under the least confidence: how many, the lowest, and their ids. A least of 0 or less flags nothing.

    A unit is a section and type, so its list is as long as what one section gives.
    """
    low = records.where((F.lit(least) > 0) & (F.col("confidence") < least))
    return low.groupBy(unit).agg(F.count(F.lit(1)).alias("flagged"), F.min("confidence").alias("lowest"), F.array_sort(F.collect_list("record_id")).alias("records"))


def completed_documents(items: DataFrame, scopes: DataFrame) -> DataFrame:
    """Documents whose items all succeeded or were skipped, by runs over whole documents: scopes (run_id, doc_id, sections), null sections being all."""
    whole = scopes.where("sections IS NULL").select("run_id", "doc_id").distinct()
    done = items.groupBy("run_id", "doc_id").agg(F.bool_and(F.col("status").isin("succeeded", "skipped")).alias("complete")).where("complete")
    return done.join(whole, ["run_id", "doc_id"], "left_semi").select("run_id", "doc_id")


def first_suppressed(titles: Column, most: int = 5) -> Column:
    """The first titles that were left out, and how many more there are."""
    more = F.size(titles) - most
    return F.concat(F.slice(titles, 1, most), F.when(more > 0, F.array(F.concat(F.lit("and "), more.cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>")))


def error_snippet(message: Column, most: int = 200) -> Column:
    return F.substring(message, 1, most)
