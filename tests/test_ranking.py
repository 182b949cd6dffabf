"""Places and classes where one group has most rows."""

import random
from collections import Counter, defaultdict
from itertools import combinations

from lodestack.functions import strings as S
from lodestack.operators import claims, ranking


def test_places_when_one_group_has_nearly_all_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b"]) if k % 50 == 0 else "hot", rng.randrange(700), "x") for k in range(6000)]
    out = ranking.placed(spark.createDataFrame(rows, "g string, v long, rank string").repartition(7), ["g"], ["v"], size="n")
    got = defaultdict(list)
    for r in out.collect():
        got[r.g].append((r.place, r.v, r.n))
    for own in got.values():
        own.sort()
        assert [p for p, _, _ in own] == list(range(1, len(own) + 1)) and {n for _, _, n in own} == {len(own)}
        assert [v for _, v, _ in own] == sorted(v for _, v, _ in own)




def test_no_task_holds_a_group(spark):
    """One group has all rows: each of the partitions that are written has its share."""
    from pyspark.sql import functions as F

    df = spark.range(40_000).select(F.lit("one").alias("g"), F.hash("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = df.repartitionByRange("g", "v").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20_000
        assert ranking.placed(df, ["g"], ["v"]).agg(F.max("place"), F.countDistinct("place")).first() == (40_000, 40_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_places_without_groups_and_rows(spark):
    df = spark.createDataFrame([(k * 7 % 50,) for k in range(50)], "v long")
    assert sorted((r.v, r.place) for r in ranking.placed(df, [], ["v"]).collect()) == [(k, k + 1) for k in range(50)]
    assert ranking.placed(df.limit(0), ["v"], ["v"]).collect() == []


CLAIMS = "bucket string, claim_id string, claim_type string, subject string, manufacturer string, family string, models array<string>, scope_revision string, signature string, claim_text string"


def contradicts(a, b):
    """The rules, claim by claim."""
    if a[0] != b[0] or a[2:6] != b[2:6] or a[8] == b[8]:
        return False
    if a[6] and b[6] and not set(a[6]) & set(b[6]):
        return False
    ra, rb = ((x[7] or "").strip().lower() for x in (a, b))
    if ra and rb and ra != rb:
        return False
    if a[2] not in ("procedure_step", "warning"):
        return True
    ta, tb = ({w for w in x[9].lower().split() if len(w) > 1 and w not in S.STOPWORDS} for x in (a, b))
    if not ta or not tb:
        return a[9].lower() != b[9].lower()
    return bool(ta & set(S.NEGATIONS)) != bool(tb & set(S.NEGATIONS)) or len(ta & tb) / len(ta | tb) >= 0.35


def test_classes_find_the_pairs_of_claims(spark):
    rng = random.Random(4)
    words = ["open", "close", "valve", "never", "not", "pump", "a", "of"]
    rows = []
    for k in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))
        models = rng.sample(["m1", "m2", "m3"], rng.choice([0, 1, 1, 2, 3]))
        rows.append((rng.choice("xy"), f"c{k:03d}", rng.choice(["spec_value", "warning", "procedure_step"]), rng.choice("st"), "ma", "fa", models, rng.choice([None, " ", "Rev A", " rev a", "b"]), text, text))
    classes, members = claims.claim_classes(spark.createDataFrame(rows, CLAIMS), ("bucket",))
    pairs = claims.class_pairs(classes, ("bucket",))
    got = Counter((r.a_claim_id, r.b_claim_id) for r in claims.expanded(pairs, members).collect())
    assert got == Counter((a[1], b[1]) for a, b in combinations(rows, 2) if contradicts(a, b))


def test_claims_that_agree_are_compared_once(spark):
    """Many claims say one thing and a few another: what is joined are classes, not claims."""
    rows = [("x", f"c{k}", "spec_value", "s", "m", "f", ["m1"] if k % 2 else [], None, "5" if k % 1000 else str(k), "5") for k in range(20_000)]
    classes, members = claims.claim_classes(spark.createDataFrame(rows, CLAIMS), ("bucket",))
    assert classes.count() == 22 and members.count() == 20_000
    assert claims.class_pairs(classes, ("bucket",)).count() < 22 * 21 / 2
    assert sum(r.claims for r in classes.select("claims").collect()) == 20_000


def test_texts_of_a_hot_subject_meet_in_blocks(spark, monkeypatch):
    """Warnings of one subject are dealt to several pairs of blocks, and no task compares them all."""
    monkeypatch.setattr(claims, "BLOCK", 16)
    rng = random.Random(7)
    words = [f"w{k}" for k in range(12)] + ["never"]
    rows = []
    for k in range(120):
        text = " ".join(rng.sample(words, rng.randint(0, 6)))
        rows.append(("x", f"c{k:03d}", "warning", "s", "m", "f", rng.choice([[], ["m1"], ["m2", "m1"], ["m3", "m2"]]), rng.choice([None, "a", "b"]), text, text))
    classes, members = claims.claim_classes(spark.createDataFrame(rows, CLAIMS), ("bucket",))
    listed = classes.where("size(models) > 0").selectExpr("*", "explode(models) AS model")
    left, right = claims._blocks(listed, listed, ["subject", "model"], "class_id")
    assert max(r["count"] for r in left.groupBy("model", "a_block", "b_block").count().collect()) < 40
    assert left.select("model", "a_block", "b_block").distinct().count() > 10
    got = Counter((r.a_claim_id, r.b_claim_id) for r in claims.expanded(claims.class_pairs(classes, ("bucket",)), members).collect())
    assert got == Counter((a[1], b[1]) for a, b in combinations(rows, 2) if contradicts(a, b))
