"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Targets: sources in code point order, null last, get the given weights in turn, and share
``share`` times all words by them. A target stops at ``most`` times its source's words; what it
can't hold is shared again by weight among the others until none is above. That fixed point is
found in closed form: with sources in order of (limit / weight), a source is full if and only if
what the ones before it leave, dealt by the weights from it on, reaches its limit.

Sampling: a target is ``whole`` certain copies of its source and a rest. Each document has the
inclusion probability p = preference * rest / (the source's words, each times its document's
preference), at most 1. Its rank is its random odds u / (1 - u) divided by its inclusion odds
p / (1 - p); in this order documents are taken once more until the rest is filled (the last one if at
least half of it fits). u comes from the MD5 of seed, doc_id and text, so reruns agree and a row's
place doesn't depend on other rows. ``preference`` is a whole number for each size; the production
query prefers longer documents (LONGER).

Scale: no task sorts a source. Ranks are put into sqrt(rows) bins for each source and summed there;
only the one bin of each source in which its rest ends is sorted, without texts. Whole rows of
documents are read again for the answer, not shuffled. The table of sources has a row
for each weight of the mix and is read by one task; it is joined by broadcast only where Spark's
size threshold lets it, else by a join that splits hot keys.

Defined cases: a null or empty text has size 0 and is taken 0 words (and as often as its source as a whole). A source without words has
target 0. Null sources are one source, null doc_ids are ordinary rows, ties of rank go by doc_id,
then size. Rows of equal doc_id and text have equal rank and are taken equally often.
An empty table gives no rows. Extra columns of any name are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.session import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the MD5 that make u: 52 bits.
DIGITS = 13
#: Words for which the production query prefers a document once more.
LONGER = 200


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size, n and target from source, source_size and n."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), place + 1)).withColumn("full", F.col("source_size") * most)
    order = Window.orderBy(F.col("full") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = (
        ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("full").over(before), F.lit(0)))
        .withColumn("weights_on", F.sum("weight").over(onward))
        .withColumn("held", F.col("left") / F.col("weights_on") >= F.col("full") / F.col("weight"))
    )
    taken = F.sum(F.when(F.col("held"), F.col("full")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("held"), 0).otherwise(F.col("weight"))).over(everything)
    dealt = left.withColumn("taken", taken).withColumn("open_weight", open_weight)
    target = F.when(F.col("held"), F.col("full").cast("double")).otherwise((F.col("total") - F.col("taken")) / F.col("open_weight") * F.col("weight"))
    return dealt.select("source", "source_size", "n", target.alias("target"))


def longer(size: Column) -> Column:
    """The production preference: 1 more for each LONGER words, up to 4."""
    return F.least(F.lit(4), 1 + F.floor(size / LONGER)).cast("long")


def _uniform(doc_id: Column, text: Column, seed: str) -> Column:
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), own)), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(16**DIGITS)


def _sized(docs: DataFrame, seed: str, preference: Callable[[Column], Column], *more: Column) -> DataFrame:
    """doc_id, source, size, liking and u of each row of docs."""
    text = F.col("text").cast("string")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text).alias("size"), _uniform(F.col("doc_id"), text, seed).alias("u"), *more)
    return named.withColumn("liking", preference(F.col("size")))


def _ranked(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """With the goals, and each row's rank from 0 to 1 and its bin."""
    p, u = F.least(F.lit(1.0), F.col("rate") * F.col("liking")), F.col("u")
    odds = F.when(p >= 1.0, 0.0).otherwise((u / (1 - u)) / (p / (1 - p)))
    rank = F.when((F.col("rate") <= 0) | (F.col("liking") <= 0), F.lit(1.0)).otherwise(odds / (1 + odds))
    return _same_source(sized, goals).withColumn("rank", rank).withColumn("bin", F.least(F.floor(F.col("rank") * F.col("bins")), F.col("bins") - 1))


def _place() -> Column:
    """Where a row stands among those of its source; equal for repeated rows only."""
    return F.struct("rank", F.when(F.col("doc_id").isNull(), 0).otherwise(1).alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), "size")


def _chosen(sized: DataFrame, goals: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of ``sized`` with source_size, target and copies. No shuffle but for tables of sources that are too large to broadcast."""
    placed = _same_source(_ranked(sized, goals), edges, "left")
    on_edge = (F.col("bin") == F.col("last_bin")) & (F.col("size") > 0) & F.coalesce(_place() <= F.col("cut"), F.lit(False))
    more = F.col("last_bin").isNull() | (F.col("bin") < F.col("last_bin")) | on_edge
    wanted = (F.col("rate") > 0) & more & (F.col("liking") > 0)
    return placed.withColumn("copies", (F.col("whole") + F.when(wanted, 1).otherwise(0)).cast("long"))


def _plan(sized: DataFrame, weights: tuple[int, ...], share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """The sources' goals, and where in the order of ranks each source's rest ends: its bin, and the last row that is taken in it."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("liking")).alias("liked"), F.count(F.lit(1)).alias("n"))
    held = F.col("source_size") > 0
    dealt = source_targets(sources.drop("liked"), weights, share, most)
    goals = materialize(
        _same_source(dealt, sources.select("source", "liked"))
        .withColumn("whole", F.when(held, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("rate", F.when(F.col("liked") > 0, F.col("rest") / F.col("liked")).otherwise(0.0))
        .withColumn("bins", F.ceil(F.sqrt(F.col("n").cast("double")))),
        "mix-goals",
    )
    ranked = _ranked(sized, goals)
    summed = ranked.groupBy("source", "bin").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    stepped = _same_source(summed.withColumn("ahead", F.coalesce(F.sum("held").over(before), F.lit(0))), goals.select("source", "rest"))
    last = stepped.where(F.col("ahead") + F.col("held") > F.col("rest")).groupBy("source").agg(F.min(F.struct("bin", "ahead")).alias("last"))
    bins = materialize(last.select("source", F.col("last.bin").alias("last_bin"), F.col("last.ahead").alias("ahead")), "mix-bins")
    inside = _same_source(ranked, bins).where((F.col("bin") == F.col("last_bin")) & (F.col("size") > 0)).withColumn("place", _place())
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("place"))  # with all rows of the same place
    alike = F.sum("size").over(Window.partitionBy("source", "place"))
    fits = inside.withColumns({"upto": upto, "alike": alike}).where(F.col("ahead") + F.col("upto") - F.col("alike") / 2 <= F.col("rest"))
    cuts = fits.groupBy("source").agg(F.max("place").alias("cut"))
    return goals, materialize(_same_source(bins.drop("ahead"), cuts, "left"), "mix-edges")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix", preference: Callable[[Column], Column] = longer) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, copies, taken (copies times size)."""
    sized = materialize(_sized(docs, seed, preference), "mix-sizes")
    chosen = _chosen(sized, *_plan(sized, weights, share, most))
    return chosen.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix", preference: Callable[[Column], Column] = longer) -> DataFrame:
    """The rows of docs, whole, each as often as the mix has it."""
    sized = materialize(_sized(docs, seed, preference), "mix-sizes")
    goals, edges = _plan(sized, weights, share, most)
    discard(sized)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    chosen = _chosen(_sized(docs, seed, preference, row), goals, edges).where("copies > 0")
    return chosen.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    other = right.withColumnRenamed("source", "their_source")
    return left.join(other, left["source"].eqNullSafe(other["their_source"]), how).drop("their_source")


#: The same rows in DuckDB SQL.
SQL = """
WITH sized AS (
  SELECT doc_id, source, size, least(4, 1 + size // 200)::BIGINT AS liking, md5(coalesce(text, '')) AS own
  FROM (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents)
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size * liking)::BIGINT AS liked, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, liked, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS room FROM sources
), held AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5 AS total,
    ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(room) OVER (ORDER BY room::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (ORDER BY room::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE >= room::DOUBLE / weight AS is_full
  FROM weighed
), targets AS (
  SELECT source, source_size, liked, CASE WHEN is_full THEN room::DOUBLE
    ELSE (total - (sum(CASE WHEN is_full THEN room ELSE 0 END) OVER ())::DOUBLE) / (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE * weight END AS target
  FROM held
), goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), rated AS (
  SELECT *, target - (whole * source_size)::DOUBLE AS rest, CASE WHEN liked > 0 THEN (target - (whole * source_size)::DOUBLE) / liked ELSE 0 END AS rate FROM goals
), drawn AS (
  SELECT d.doc_id, d.size, g.source, g.source_size, g.target, g.whole, g.rest, g.rate, least(1.0::DOUBLE, g.rate * d.liking) AS p,
    (('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || own), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM sized d JOIN rated g ON d.source IS NOT DISTINCT FROM g.source
), ranked AS (
  SELECT *, CASE WHEN rate <= 0 THEN 1 WHEN p >= 1 THEN 0 ELSE (u / (1 - u)) / (p / (1 - p)) END AS odds FROM drawn
), summed AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id NULLS FIRST, size))::DOUBLE AS upto, (sum(size) OVER (PARTITION BY source, odds, doc_id, size))::DOUBLE AS alike FROM ranked
)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN rate > 0 AND upto - alike / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM summed
"""
