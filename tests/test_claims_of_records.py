"""Claims of records: where they apply, and which meet in a bucket."""

from lodestack.operators import claims, records

SCOPE = "struct<manufacturer: string, family: string, models: array<string>, revision: string>"
RECORD = f"""doc_id string, record_id string, record_type string, applicability {SCOPE}, document {SCOPE}, title string, parameter string, value string, unit string, conditions string, code string,
  description string, cause string, remedy string, severity string, context string, source_heading string, text string, steps array<struct<step_number: int, instruction: string>>,
  warnings array<struct<severity: string, text: string, context: string, applicability: {SCOPE}>>"""


def record(doc, name, kind, own, document, **fields):
    row = dict.fromkeys(("title", "parameter", "value", "unit", "conditions", "code", "description", "cause", "remedy", "severity", "context", "source_heading", "text", "steps", "warnings")) | fields
    return (doc, name, kind, own, document, *row.values())


def spec(doc, value, models=("DC1000",), own=None, revision="Rev 3"):
    return record(doc, f"{doc}-spec", "spec_value", own, ("Honey", "DC1000", list(models), revision), parameter="Supply voltage", value=value, unit="VDC", conditions="Nominal input")


def met(spark, rows, buckets):
    found = records.claims_of_records(spark.createDataFrame(rows, RECORD)).join(spark.createDataFrame(buckets, "doc_id string, bucket_id string"), "doc_id")
    flat = found.selectExpr("bucket_id", "record_id AS claim_id", "claim_type", "subject", "scope.manufacturer", "scope.family", "scope.models", "scope.revision AS scope_revision", "signature", "claim_text")
    classes, members = claims.claim_classes(flat, ("bucket_id",))
    return sorted((r.bucket_id, r.a_claim_id, r.b_claim_id) for r in claims.expanded(claims.class_pairs(classes, ("bucket_id",)), members).collect())


def test_claims_of_other_buckets_do_not_meet(spark):
    rows = [spec("m", "24"), spec("o", "48")]
    assert met(spark, rows, [("m", "family"), ("o", "authority")]) == []
    assert met(spark, rows, [("m", "family"), ("o", "family"), ("o", "authority")]) == [("family", "m-spec", "o-spec")]


def test_claims_of_other_models_and_revisions_do_not_meet(spark):
    rows = [spec("a", "24"), spec("b", "48", ("DC2000",)), spec("c", "12", ()), spec("d", "6", ("dc1000", "x"), revision=" rev 3"), spec("e", "3", revision="Rev 4"), spec("f", "2", revision=" ")]
    pairs = {(a, b) for _, a, b in met(spark, rows, [(r[0], "k") for r in rows])}
    assert pairs == {(f"{a}-spec", f"{b}-spec") for a, b in ("ac", "ad", "af", "bc", "bf", "cd", "cf", "df", "ef")} - {("b-spec", "f-spec")} | {("c-spec", "d-spec")}


def test_values_and_alarms_apply_where_their_document_does(spark):
    own, document = ("Own", "Fam", ["M"], "R1"), ("Doc", "DocFam", ["D"], None)
    rows = [
        record("d", "v", "spec_value", own, document, parameter="p", value="1"),
        record("d", "a", "alarm_definition", own, document, code="E1", description="x", cause="y", remedy="z", severity="High"),
        record("d", "w", "warning", own, document, severity="Danger", text="hot", source_heading="h"),
        record("d", "p", "procedure", own, document, title="t", steps=[(1, "Open")], warnings=[("Danger", "hot", None, None), ("Danger", "cold", None, ("In", "F", [], None))]),
    ]
    got = {(r.record_id): r.scope.manufacturer for r in records.claims_of_records(spark.createDataFrame(rows, RECORD)).collect()}
    assert got == {"v": "doc", "a": "doc", "w": "own", "p::step-001": "own", "p::warning-001": "own", "p::warning-002": "in"}
