"""Queries on work items, batches, budgets, costs and results."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestack.functions import json_rules
from lodestack.functions import vocabulary as V
from lodestack.operators import extraction as O
from lodestack.operators import records as R
from lodestack.operators import structure
from lodestack.plans.registry import query
from lodestack.plans.structure import _CLASSIFIED, SECTION_ID, classified_sections
from lodestack.plans.views import LOG, log, table

_TYPES = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(t) for t in v)}]" for k, v in V.RECORD_TYPES.items())
_ITEMS = f"""{_CLASSIFIED}, identified AS (SELECT *, {SECTION_ID} AS section_id FROM classified),
fanned AS (SELECT doc_id, section_no, section_id, section_type, title, content, CASE section_type {_TYPES} END AS types FROM identified),
work AS (SELECT doc_id, section_no, section_id, section_type, title, content, unnest(types) AS record_type FROM fanned),
sized AS (SELECT *, section_id || '::' || record_type AS item_id, greatest(length(content) // 4, 1) + 4096 AS tokens FROM work)"""


def _items(spark, sf_dir):
    s = classified_sections(spark, sf_dir)
    s = s.withColumn("section_id", structure.section_id(F.concat(F.lit("d"), s.doc_id.cast("string")), s.title, s.content))
    return O.work_items(s).withColumn("tokens", O.estimate_tokens(F.length("content"), F.lit(4096)))


@query(f"WITH {_ITEMS} SELECT doc_id, section_no, record_type, item_id FROM sized")
def work_items(spark, sf_dir):
    return _items(spark, sf_dir).select("doc_id", "section_no", "record_type", "item_id")


@query(f"WITH {_ITEMS} SELECT item_id, section_no, substr(sha256(item_id || chr(10) || content || chr(10) || 'v1'), 1, 12) AS fp FROM sized")
def work_fingerprint(spark, sf_dir):
    return _items(spark, sf_dir).select("item_id", "section_no", O.fingerprint(F.col("item_id"), F.col("content"), F.lit("v1")).alias("fp"))


_RULES = [
    {"retry_class": "rate_limit", "record_types": ["procedure"], "model": "gpt-4.1"},
    {"record_types": ["alarm_definition", "spec_value"], "model": "gpt-4.1-mini"},
    {"section_types": ["safety", "troubleshooting"], "min_tokens": 54, "model": "gpt-4.1"},
    {"max_tokens": 14, "model": "gpt-4o-mini"},
]


@query(f"""WITH {_ITEMS}, retried AS (SELECT *, tokens - 4096 AS prompt, CASE section_no % 4 WHEN 0 THEN 'HTTP 429' WHEN 1 THEN 'Too Many Requests' WHEN 2 THEN 'code 4290' END AS error FROM sized)
  SELECT doc_id, section_no, item_id, CASE WHEN section_no % 4 IN (0, 1) AND record_type = 'procedure' THEN 'gpt-4.1' WHEN record_type IN ('alarm_definition', 'spec_value') THEN 'gpt-4.1-mini'
  WHEN section_type IN ('safety', 'troubleshooting') AND prompt >= 54 THEN 'gpt-4.1' WHEN prompt <= 14 THEN 'gpt-4o-mini' ELSE 'gpt-4o' END AS model FROM retried""")
def model_routing(spark, sf_dir):
    n = F.col("section_no") % 4
    error = F.when(n == 0, "HTTP 429").when(n == 1, "Too Many Requests").when(n == 2, "code 4290")
    items = _items(spark, sf_dir).withColumn("retry_class", O.retry_class(error)).withColumn("prompt_tokens", F.col("tokens") - 4096)
    return O.route(items, _RULES, "gpt-4o").select("doc_id", "section_no", "item_id", "model")


@query(f"WITH {_ITEMS} SELECT doc_id, count(*) AS items, sum(tokens)::BIGINT AS tokens FROM sized GROUP BY doc_id")
def token_estimate(spark, sf_dir):
    return _items(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("tokens"))


def _queue(spark, sf_dir):
    return table(spark, sf_dir, "documents").select((F.col("doc_id") % 50).alias("run"), "doc_id", (F.col("n_chars") % 900 + 60).alias("tokens"), F.when(F.col("doc_id") % 7 < 4, "gpt-4o").otherwise("gpt-4o-mini").alias("model"))


@query(
    """WITH RECURSIVE queue AS (SELECT doc_id % 50 AS run, doc_id, n_chars % 900 + 60 AS tokens, CASE WHEN doc_id % 7 < 4 THEN 'gpt-4o' ELSE 'gpt-4o-mini' END AS model, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id) AS place FROM documents),
  packed AS (SELECT run, doc_id, tokens, model, place, 0::BIGINT AS chunk, 1 AS held, tokens AS total FROM queue WHERE place = 1
    UNION ALL SELECT q.run, q.doc_id, q.tokens, q.model, q.place, CASE WHEN p.held >= 5 OR p.total + q.tokens > 2000 OR p.model <> q.model THEN p.chunk + 1 ELSE p.chunk END,
      CASE WHEN p.held >= 5 OR p.total + q.tokens > 2000 OR p.model <> q.model THEN 1 ELSE p.held + 1 END, CASE WHEN p.held >= 5 OR p.total + q.tokens > 2000 OR p.model <> q.model THEN q.tokens ELSE p.total + q.tokens END
    FROM packed p JOIN queue q ON q.run = p.run AND q.place = p.place + 1)
  SELECT run, doc_id, tokens, model, chunk FROM packed"""
)
def batch_chunks(spark, sf_dir):
    return O.chunks(_queue(spark, sf_dir), "run", "doc_id", most=5, budget=2000)


@query(
    """WITH RECURSIVE queue AS (SELECT doc_id % 50 AS run, doc_id, n_chars % 900 + 60 AS tokens, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id) AS place FROM documents),
  sim AS (SELECT DISTINCT run, 0::BIGINT AS place, NULL::BIGINT AS doc_id, NULL::BIGINT AS tokens, 0.0::DOUBLE AS starts_at, []::DOUBLE[] AS times, []::BIGINT[] AS sizes FROM queue
    UNION ALL SELECT run, place, doc_id, tokens, CASE WHEN k = 0 THEN clock ELSE live[k] + 60 END, list_append(live[k + 1:], CASE WHEN k = 0 THEN clock ELSE live[k] + 60 END), list_append(held[k + 1:], tokens)
    FROM (SELECT *, list_filter(range(0, len(live) + 1), lambda x: len(live) - x < 5 AND coalesce(list_sum(held[x + 1:]), 0) + tokens <= 2000)[1] AS k
      FROM (SELECT *, sizes[len(times) - len(live) + 1:] AS held
        FROM (SELECT q.run, q.place, q.doc_id, q.tokens::BIGINT AS tokens, s.starts_at AS clock, s.times, s.sizes, list_filter(s.times, lambda t: s.starts_at - t < 60) AS live FROM sim s JOIN queue q ON q.run = s.run AND q.place = s.place + 1))))
  SELECT run, doc_id, tokens, starts_at FROM sim WHERE place > 0"""
)
def scheduler_sim(spark, sf_dir):
    return O.schedule(_queue(spark, sf_dir).drop("model"), "run", "doc_id", requests=5, budget=2000)


@query(f"""WITH {LOG} SELECT event_id, count(*) OVER w AS requests, (sum(prompt_tokens) OVER w)::BIGINT AS tokens FROM log
  WINDOW w AS (PARTITION BY model ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)""")
def rolling_budget(spark, sf_dir):
    return O.rolling_budget(log(spark, sf_dir), "model", "ts", "prompt_tokens", 3600).select("event_id", "requests", "tokens")


_PRICED = f"""{LOG}, named AS (SELECT *, CASE event_id % 5 {' '.join(f"WHEN {n} THEN '{m}'" for n, m in enumerate(O.PRICES))} ELSE 'other' END AS price_model FROM log),
priced AS (SELECT price_model AS model, ts::DATE AS day, run, prompt_tokens, completion_tokens, CASE price_model {' '.join(f"WHEN '{m}' THEN ((prompt_tokens * {int(a * 100)} + completion_tokens * {int(b * 100)})::DECIMAL(28,0) / 100000000)::DECIMAL(18,8)" for m, (a, b) in O.PRICES.items())} ELSE 0::DECIMAL(18,8) END AS cost FROM named)"""


@query(f"""WITH {_PRICED}, rolled AS (SELECT grouping_id(model, day, run) AS g, model, day, run, count(*) AS requests, sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens, sum(cost)::DOUBLE AS cost
    FROM priced GROUP BY GROUPING SETS ((), (model), (day), (run)))
  SELECT CASE g WHEN 7 THEN 'total' WHEN 3 THEN 'model' WHEN 5 THEN 'date' ELSE 'run' END AS scope, coalesce(model, day::VARCHAR, run) AS key, requests, prompt_tokens, completion_tokens, round(cost, 6) AS cost
  FROM rolled WHERE NOT (g = 6 AND run IS NULL)""")
def cost_rollup(spark, sf_dir):
    own = log(spark, sf_dir)
    name = F.coalesce(*[F.when(F.col("event_id") % 5 == n, m) for n, m in enumerate(O.PRICES)], F.lit("other"))
    named = own.withColumn("model", name).withColumn("day", F.to_date("ts"))
    priced = named.withColumn("cost", O.cost(F.col("prompt_tokens"), F.col("completion_tokens"), F.col("model")))
    return O.cost_rollup(priced).withColumn("cost", F.round(F.col("cost").cast("double"), 6))


_STATUS = "['pending', 'in_progress', 'succeeded', 'failed', 'skipped', 'succeeded', 'succeeded'][(event_id % 7 + 1)::INTEGER]"


def _run_items(spark, sf_dir):
    names = F.array(*[F.lit(s) for s in ("pending", "in_progress", "succeeded", "failed", "skipped", "succeeded", "succeeded")])
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.element_at(names, (F.col("event_id") % 7 + 1).cast("int")).alias("status"))


@query(f"""WITH items AS (SELECT user_id, event_id, {_STATUS} AS status FROM events), counts AS (SELECT user_id, count(*) FILTER (WHERE status = 'pending') AS pending,
    count(*) FILTER (WHERE status = 'in_progress') AS in_progress, count(*) FILTER (WHERE status = 'succeeded') AS succeeded, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped FROM items GROUP BY user_id)
  SELECT *, CASE WHEN failed > 0 THEN 'failed' WHEN pending + in_progress > 0 THEN 'running' ELSE 'completed' END AS run_status FROM counts""")
def run_metrics(spark, sf_dir):
    counts = O.status_counts(_run_items(spark, sf_dir), "user_id")
    return counts.withColumn("run_status", O.run_status(counts))


@query(f"""WITH items AS (SELECT user_id % 3 AS run_id, user_id AS doc_id, {_STATUS} AS status FROM events WHERE user_id % 2 = 0 UNION ALL SELECT user_id % 3, user_id, 'skipped' FROM events WHERE user_id % 2 = 1)
  SELECT run_id, doc_id FROM items WHERE doc_id % 5 <> 0 GROUP BY ALL HAVING bool_and(status IN ('succeeded', 'skipped'))""")
def doc_complete(spark, sf_dir):
    u = F.col("user_id")
    own = _run_items(spark, sf_dir).select((u % 3).alias("run_id"), u.alias("doc_id"), F.when(u % 2 == 0, F.col("status")).otherwise("skipped").alias("status"))
    scopes = own.select("run_id", "doc_id", F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("s1"))).alias("sections")).distinct()
    return R.completed_documents(own, scopes)


@query(f"""WITH items AS (SELECT user_id, event_id, {_STATUS} AS status FROM events)
  SELECT event_id, CASE WHEN event_id % 4 = 0 OR event_id % 6 = 1 OR status = 'in_progress' THEN 'pending' ELSE status END AS status FROM items""")
def resume_reconcile(spark, sf_dir):
    items = _run_items(spark, sf_dir)
    i = F.col("event_id")
    now = items.select(i.alias("item_id"), (i * 3).cast("string").alias("fp"))
    before = items.where(i % 4 != 0).select(i.alias("item_id"), F.when(i % 6 == 1, "changed").otherwise((i * 3).cast("string")).alias("fp"), "status")
    return O.reconcile(now, before).select(F.col("item_id").alias("event_id"), "status")


_RESULTS = """results AS (SELECT conv_id, turn, conv_id || '-' || turn AS custom_id, role || ' said ' || CASE (conv_id + turn) % 6 WHEN 0 THEN 'Rate limit reached' WHEN 1 THEN 'content policy' WHEN 2 THEN 'Schema invalid: x' WHEN 3 THEN 'read timeout' ELSE coalesce(text, '') END AS message,
  CASE (conv_id + turn) % 7 WHEN 0 THEN 429 WHEN 1 THEN 408 WHEN 2 THEN 500 ELSE 200 END AS status FROM conversations)"""
_FAILURE = """CASE WHEN status = 429 OR contains(lower(message), 'rate limit') THEN 'rate_limit' WHEN contains(lower(message), 'content policy') OR contains(lower(message), 'safety system') THEN 'content_policy'
  WHEN contains(lower(message), 'schema invalid') OR contains(lower(message), 'did not satisfy schema') THEN 'schema_invalid' WHEN status = 408 OR contains(lower(message), 'timeout') THEN 'timeout' WHEN status IN (500, 503) THEN 'server_error' ELSE 'unknown' END"""


def _results(spark, sf_dir):
    n = F.col("conv_id") + F.col("turn")
    said = F.when(n % 6 == 0, "Rate limit reached").when(n % 6 == 1, "content policy").when(n % 6 == 2, "Schema invalid: x").when(n % 6 == 3, "read timeout").otherwise(F.coalesce("text", F.lit("")))
    status = F.when(n % 7 == 0, 429).when(n % 7 == 1, 408).when(n % 7 == 2, 500).otherwise(200)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("custom_id"), F.concat("role", F.lit(" said "), said).alias("message"), status.alias("status"))


@query(f"WITH {_RESULTS}, judged AS (SELECT custom_id, {_FAILURE} AS error_type FROM results) SELECT custom_id, error_type, error_type IN ('rate_limit', 'timeout', 'server_error') AS retriable FROM judged")
def failure_classes(spark, sf_dir):
    r = _results(spark, sf_dir)
    kind = O.failure_class(r.message, r.status)
    return r.select("custom_id", kind.alias("error_type"), O.retriable(kind).alias("retriable"))


@query(f"""WITH {_RESULTS} SELECT custom_id, CASE WHEN status <> 200 AND turn % 3 <> 1 THEN 'failed' WHEN turn % 2 = 0 THEN 'succeeded' ELSE 'missing' END AS outcome,
  CASE WHEN status <> 200 AND turn % 3 <> 1 THEN {_FAILURE} END AS error_type FROM results""")
def batch_reconcile(spark, sf_dir):
    r = _results(spark, sf_dir)
    failures = r.where("status <> 200 AND turn % 3 <> 1").withColumn("error_type", O.failure_class(r.message, r.status))
    return O.settle(r.select("custom_id"), r.where("turn % 2 = 0"), failures).select("custom_id", "outcome", "error_type")


@query("""SELECT doc_id, round((CASE WHEN doc_id % 10 <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN doc_id % 7 = 0 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END + greatest(0.0::DOUBLE, least(1.0::DOUBLE, (doc_id % 113)::DOUBLE * 0.97::DOUBLE / 100)) + greatest(0.0::DOUBLE, 1 - least(n_chars::DOUBLE / 7919, 1.0::DOUBLE))) / 4, 3) AS confidence,
  round((CASE WHEN doc_id % 10 <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN doc_id % 7 = 0 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END + greatest(0.0::DOUBLE, least(1.0::DOUBLE, (doc_id % 113)::DOUBLE * 0.97::DOUBLE / 100)) + greatest(0.0::DOUBLE, 1 - least(n_chars::DOUBLE / 7919, 1.0::DOUBLE))) / 4, 3) < 0.75 AS flagged FROM documents""")
def confidence_score(spark, sf_dir):
    d = F.col("doc_id")
    score = O.confidence(d % 10 != 0, d % 7 == 0, (d % 113).cast("double") * 0.97, F.col("n_chars").cast("double"), F.lit(7919.0))
    return table(spark, sf_dir, "documents").select("doc_id", score.alias("confidence"), (score < 0.75).alias("flagged"))


@query("""WITH records AS (SELECT doc_id, doc_id // 10 AS section, (doc_id * 37) % 100 / 100.0 AS confidence FROM documents)
  SELECT section, count(*) AS flagged, min(confidence)::DOUBLE AS lowest, array_to_string(list_sort(list(doc_id)), ',') AS records FROM records WHERE confidence < 0.3 GROUP BY section""")
def review_flags(spark, sf_dir):
    c = (F.col("doc_id") * 37) % 100 / 100
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), F.floor(F.col("doc_id") / 10).alias("section"), c.alias("confidence"))
    return R.review_flags(own, "section", 0.3).withColumn("records", F.array_join(F.col("records").cast("array<string>"), ","))


@query("""WITH records AS (SELECT doc_id, lang, CASE WHEN doc_id % 9 = 0 THEN '' ELSE source END AS source_doc, CASE WHEN doc_id % 8 <> 0 THEN doc_id % 5 END AS page_from, doc_id % 6 AS page_to, (doc_id % 13) / 12.0 + CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END AS confidence FROM documents),
  judged AS (SELECT doc_id, lang, list_sort(list_filter([CASE WHEN NOT confidence BETWEEN 0 AND 1 THEN 'confidence' END, CASE WHEN NOT coalesce(page_from <= page_to, false) THEN 'page_order' END,
    CASE WHEN page_from IS NULL OR page_to IS NULL THEN 'page_range' END, CASE WHEN length(source_doc) = 0 THEN 'source_doc' END], lambda e: e IS NOT NULL)) AS errors FROM records)
  SELECT lang, count(*) AS total, count(*) FILTER (WHERE len(errors) = 0) AS valid, count(*) FILTER (WHERE len(errors) > 0) AS invalid, count(*) FILTER (WHERE list_contains(errors, 'page_order')) AS page_order FROM judged GROUP BY lang""")
def provenance_audit(spark, sf_dir):
    d = F.col("doc_id")
    records = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.when(d % 9 == 0, "").otherwise(F.col("source")).alias("source_doc"), F.when(d % 8 != 0, d % 5).alias("page_from"), (d % 6).alias("page_to"), ((d % 13) / 12 + F.when(d % 17 == 0, 1).otherwise(0)).alias("confidence")
    )
    judged = records.withColumn("errors", O.provenance_errors(records))
    return judged.groupBy("lang").agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(F.size("errors") == 0, 1)).alias("valid"), F.count(F.when(F.size("errors") > 0, 1)).alias("invalid"), F.count(F.when(F.array_contains("errors", "page_order"), 1)).alias("page_order")
    )


@query(f"""WITH {_ITEMS} SELECT item_id, len(regexp_extract_all(content, '\\d+(?:\\.\\d+)?\\s?(?:mm|cm|V|A|W|Hz|kg|psi|°C)\\b')) AS values, regexp_matches(content, '(?i)\\b(?:danger|warning|caution)\\b') AS severe,
  len(list_filter(regexp_split_to_array(content, '\\s+'), lambda w: w <> '')) AS words FROM sized""")
def extract_offline(spark, sf_dir):
    return O.run_backend(_items(spark, sf_dir).select("item_id", "content"), O.offline_rules, "item_id string, values long, severe boolean, words long")


_MESSAGES = "CASE event_id % 4 WHEN 0 THEN 'Rate limit: TRY AGAIN in ' || (event_id % 90) || '.5s please' WHEN 1 THEN 'try again in ' || event_id % 700 || ' ms' WHEN 2 THEN 'Temporarily unavailable' ELSE 'bad ' || event_type END"


def _messages():
    e = F.col("event_id")
    return (
        F.when(e % 4 == 0, F.concat(F.lit("Rate limit: TRY AGAIN in "), e % 90, F.lit(".5s please")))
        .when(e % 4 == 1, F.concat(F.lit("try again in "), e % 700, F.lit(" ms")))
        .when(e % 4 == 2, "Temporarily unavailable")
        .otherwise(F.concat(F.lit("bad "), "event_type"))
    )


@query(f"""WITH m AS (SELECT event_id, lower({_MESSAGES}) AS m FROM events)
  SELECT event_id, CASE WHEN regexp_extract(m, 'try again in ([0-9]+(?:\\.[0-9]+)?)\\s*(ms|s)\\b', 1) = '' THEN 0.0::DOUBLE ELSE regexp_extract(m, 'try again in ([0-9]+(?:\\.[0-9]+)?)\\s*(ms|s)\\b', 1)::DOUBLE / CASE WHEN regexp_extract(m, 'try again in ([0-9]+(?:\\.[0-9]+)?)\\s*(ms|s)\\b', 2) = 'ms' THEN 1000 ELSE 1 END END AS wait,
    event_id % 7 = 0 OR contains(m, 'timeout') OR contains(m, 'temporarily unavailable') OR contains(m, 'rate limit') AS transient FROM m""")
def retry_hints(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("m", _messages())
    return events.select("event_id", O.retry_hint(F.col("m")).alias("wait"), O.transient(F.col("m"), F.when(F.col("event_id") % 7 == 0, 503).otherwise(400)).alias("transient"))


@query("SELECT doc_id, sha256(regexp_replace(text, '[^\\p{L}\\p{N}_-]', '-', 'g')) AS name_hash FROM documents WHERE text IS NOT NULL")
def log_names(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.sha2(O.file_name(F.col("text")), 256).alias("name_hash"))


_SCHEMA = {"type": "object", "required": ["k", "more"], "properties": {"k": {"type": "integer", "minimum": 40}}}


@query("""SELECT event_id, concat_ws('; ', CASE WHEN (props->>'k')::BIGINT < 40 THEN '$.k: is less than 40' END, '$: lacks more') AS errors FROM events""")
def json_validate(spark, sf_dir):
    errors = json_rules.json_errors(F.col("props"), _SCHEMA)
    return table(spark, sf_dir, "events").select("event_id", F.array_join(errors, "; ").alias("errors"))
