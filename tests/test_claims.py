"""Claims: what their authority goes by, and which pairs of them meet."""

import re

from pyspark.sql import functions as F

from lodestack.functions import strings as S
from lodestack.functions import vocabulary as V
from lodestack.operators import claims, intake
from lodestack.plans import claims as plans

#: Bytes of a method above which the JVM leaves it to the interpreter.
HUGE = 8000


def papers(spark):
    types = [*V.DOCUMENT_TYPES[:12], *V.LEGACY_DOCUMENT_TYPES, " Service  Manual ", "BULLETIN", "Maßblatt", "", None]
    classes = [*V.DOCUMENT_CLASSES, "Operational", "CONTEXTUAL", None]
    revisions = ["original", " Rev A ", "Rev C", "3", "v2.1", "current", "R0", " ", "??", "ﬁrst edition", None]
    rows = [(t, c, r) for t in types for c in classes for r in revisions]
    return spark.createDataFrame(rows, "document_type string, document_class string, revision string")


def methods(df):
    """The largest method of each generated stage of df's plan, in bytes."""
    spark = df.sparkSession
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df.select("*")._jdf.queryExecution().executedPlan()))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_authority_is_level_kind_and_edition(spark):
    own = [F.col(c) for c in ("document_type", "document_class", "revision")]
    expected = {"level": intake.precedence(*own), "kind": S.fold(own[0]), "edition": S.revision_key(own[2])}
    found = claims.authority(papers(spark))
    assert set(found.columns) == {"document_type", "document_class", "revision", *expected}
    wrong = ~F.expr("true")
    for name, column in expected.items():
        wrong = wrong | ~F.col(name).eqNullSafe(column)
    assert found.where(wrong).count() == 0
    assert {r.level for r in found.select("level").distinct().collect()} == set(range(1, 9))


def test_supplier_authority_is_compiled(spark, data):
    """Before, the suppliers' stage had a method of 19,954 bytes."""
    sizes = methods(plans.spec_claims(spark, data))
    assert sizes and max(sizes) < HUGE


def test_lines_are_numbered_in_several_tasks_a_core(spark, data):
    """However few bytes they have, since the work on them isn't small."""
    plan = plans.spec_claims(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    many = re.search(r"RepartitionByExpression \[l_orderkey.*\], (\d+)", plan)
    assert many and int(many.group(1)) >= 4 * spark.sparkContext.defaultParallelism


def test_blank_revisions_of_a_claim_meet_all(spark):
    rows = [("a", " Rev\u00a0A ", "1"), ("b", "rev\u00a0a", "2"), ("c", "B", "3"), ("d", " \u2003", "4"), ("e", None, "5"), ("f", "b", "3")]
    own = spark.createDataFrame(rows, "claim_id string, scope_revision string, signature string").selectExpr(
        "claim_id", "'spec_value' AS claim_type", "'s' AS subject", "'m' AS manufacturer", "'f' AS family", "array() :: array<string> AS models", "scope_revision", "signature"
    )
    pairs = {r.a_claim_id + r.b_claim_id for r in claims.comparable_pairs(own).collect()}
    assert pairs == {"ab", "ad", "ae", "bd", "be", "cd", "ce", "de", "df", "ef"}
