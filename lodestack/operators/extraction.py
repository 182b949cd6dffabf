"""Work items of sections: what to extract, by which model, in which batches, at what cost, with what result."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.functions import strings as S
from lodestack.functions import vocabulary as V
from lodestack.operators.batching import chunks  # noqa: F401 - one of these operators

# Dollars for a million tokens, in and out.
PRICES = {"gpt-4o": (2.50, 10.00), "gpt-4o-mini": (0.15, 0.60), "gpt-4.1": (2.00, 8.00), "gpt-4.1-mini": (0.40, 1.60)}
STATUSES = ("pending", "in_progress", "succeeded", "failed", "skipped")


def work_items(sections: DataFrame) -> DataFrame:
    """A row for each section and type of record to extract from it, with its item_id."""
    types = F.create_map(*[x for k, v in V.RECORD_TYPES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    spread = sections.select("*", F.posexplode(F.try_element_at(types, F.col("section_type"))).alias("ordinal", "record_type"))
    return spread.withColumn("item_id", F.concat_ws("::", "section_id", "record_type"))


def fingerprint(*parts: Column) -> Column:
    """A short digest of what an item's result depends on."""
    return S.digest(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 12)


def reconcile(now: DataFrame, before: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Items (item_id, fp) with the status they start from, given earlier rows (item_id, fp, status)."""
    old = before.select("item_id", F.col("fp").alias("old_fp"), F.col("status").alias("old_status"))
    again = F.col("old_status").isNull() | (F.col("old_fp") != F.col("fp")) | (F.col("old_status") == "in_progress")
    if retry_failed:
        again = again | (F.col("old_status") == "failed")
    return now.join(old, "item_id", "left").withColumn("status", F.when(again, "pending").otherwise(F.col("old_status"))).drop("old_fp", "old_status")


def estimate_tokens(chars: Column, max_tokens: Column) -> Column:
    return F.greatest(F.floor(chars / 4.0), F.lit(1)).cast("long") + max_tokens


def retry_class(message: Column) -> Column:
    """``rate_limit`` for what the message of the last failure calls a limit on rates, else null."""
    m = F.lower(message)
    return F.when(F.contains(m, F.lit("rate limit")) | F.contains(m, F.lit("too many requests")) | m.rlike(r"\b429\b"), "rate_limit")


def route(items: DataFrame, rules: list[dict], default: str) -> DataFrame:
    """items with ``model``: of the ordered rules the first that fits retry_class, record_type, section_type and prompt_tokens."""
    out = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        ok = F.lit(True) if rule.get("retry_class") is None else F.col("retry_class").eqNullSafe(rule["retry_class"])
        if rule.get("record_types"):
            ok = ok & F.col("record_type").isin(*rule["record_types"])
        if rule.get("section_types"):
            ok = ok & F.col("section_type").isin(*rule["section_types"])
        if rule.get("min_tokens") is not None:
            ok = ok & (F.col("prompt_tokens") >= rule["min_tokens"])
        if rule.get("max_tokens") is not None:
            ok = ok & (F.col("prompt_tokens") <= rule["max_tokens"])
        out = out.when(ok, F.lit(rule["model"]))
    return items.withColumn("model", out.otherwise(F.lit(default)))


def schedule(items: DataFrame, group: str, order: str, requests: int, budget: int, seconds: float = 60.0, attempts: int = 1000) -> DataFrame:
    """items with ``starts_at`` (seconds): dispatched in order under rolling limits on requests and tokens. Items over the budget never start."""

    def simulate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, ignore_index=True)
        now, sent, out = 0.0, [], []
        for own in pdf["tokens"]:
            if own > budget:
                out.append(None)
                continue
            for _ in range(attempts):
                sent = [(t, n) for t, n in sent if now - t < seconds]
                if len(sent) < requests and sum(n for _, n in sent) + own <= budget:
                    break
                now = sent[0][0] + seconds
            sent.append((now, own))
            out.append(now)
        return pdf.assign(starts_at=pd.array(out, "Float64"))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields) + ", starts_at double"
    return items.groupBy(group).applyInPandas(simulate, schema)


def rolling_budget(log: DataFrame, key: str, ts: str, tokens: str, seconds: int) -> DataFrame:
    """log with the requests and tokens of the last ``seconds``, half open: what is exactly as old has expired.

    Time is cut into spans of that length: a row comes in its own span and goes in the next. What is live is what was there when
    the span began, all rows of the one before, and what has come since less what has gone, which are running sums: no row
    looks at all that it counts, however dense the log is. Groups are as large as one key's rows of two spans. tokens are whole numbers.
    """
    width = seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    comes, had = F.col("_way") == 1, F.col(tokens).isNotNull().cast("int")
    own = log.withColumns({"_at": micros, "_span": F.floor(micros / width)}).where("_span IS NOT NULL").withColumn("_way", F.explode(F.array(F.lit(1), F.lit(-1))))
    moves = own.withColumns({"_at": F.when(comes, F.col("_at")).otherwise(F.col("_at") + width), "_span": F.when(comes, F.col("_span")).otherwise(F.col("_span") + 1)})
    group = Window.partitionBy(key, "_span")
    until = group.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    live = lambda n: F.coalesce(F.sum(F.when(~comes, n)).over(group), F.lit(0)) + F.sum(F.col("_way") * n).over(until)
    known = F.when(live(had) > 0, live(F.coalesce(F.col(tokens), F.lit(0))))
    return moves.withColumns({"requests": live(F.lit(1)), "tokens": known}).where(comes).drop("_at", "_way", "_span")


def failure_class(message: Column, status: Column) -> Column:
    m = F.lower(message)
    has = lambda x: F.contains(m, F.lit(x))
    return (
        F.when((status == 429) | has("rate limit"), "rate_limit")
        .when(has("content policy") | has("safety system"), "content_policy")
        .when(has("schema invalid") | has("did not satisfy schema"), "schema_invalid")
        .when((status == 408) | has("timeout"), "timeout")
        .when(status.isin(500, 503), "server_error")
        .otherwise("unknown")
    )


def retriable(kind: Column) -> Column:
    return kind.isin("rate_limit", "timeout", "server_error")


def settle(requests: DataFrame, successes: DataFrame, failures: DataFrame) -> DataFrame:
    """Each request's outcome: succeeded, failed (even if it succeeded too) or missing."""
    ok = successes.select("custom_id").distinct().withColumn("ok", F.lit(True))
    bad = failures.groupBy("custom_id").agg(F.min("error_type").alias("error_type"))
    joined = requests.join(ok, "custom_id", "left").join(bad, "custom_id", "left")
    return joined.withColumn("outcome", F.when(F.col("error_type").isNotNull(), "failed").when(F.col("ok"), "succeeded").otherwise("missing")).drop("ok")


def cost(prompt: Column, completion: Column, model: Column) -> Column:
    """Dollars, to 8 decimals; 0 for unknown models."""
    million = F.lit(1_000_000).cast("decimal(18,0)")
    out = F.lit(0).cast("decimal(18,8)")
    for name, (a, b) in PRICES.items():
        price = (prompt.cast("decimal(18,0)") * F.lit(str(a)).cast("decimal(6,2)") + completion.cast("decimal(18,0)") * F.lit(str(b)).cast("decimal(6,2)")) / million
        out = F.when(model == name, price.cast("decimal(18,8)")).otherwise(out)
    return out


def cost_rollup(log: DataFrame) -> DataFrame:
    """Requests, tokens and cost in all, by model, by UTC date and by run; requests without a run aren't in the last."""
    sums = """SELECT grouping_id(model, day, run) AS g, model, day, run, count(*) AS requests, sum(prompt_tokens) AS prompt_tokens,
                sum(completion_tokens) AS completion_tokens, sum(cost) AS cost
              FROM {log} GROUP BY GROUPING SETS ((), (model), (day), (run))"""
    rolled = log.sparkSession.sql(sums, log=log).where("NOT (g = 6 AND run IS NULL)")
    scope = F.when(F.col("g") == 7, "total").when(F.col("g") == 3, "model").when(F.col("g") == 5, "date").otherwise("run")
    return rolled.select(scope.alias("scope"), F.coalesce("model", F.col("day").cast("string"), "run").alias("key"), "requests", "prompt_tokens", "completion_tokens", "cost")


def status_counts(items: DataFrame, key: str) -> DataFrame:
    """Items of each status for each key, 0 where there are none."""
    return items.groupBy(key).agg(*[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES])


def run_status(counts: DataFrame) -> Column:
    """A run's status from its counts: failed wins, even over what is still to do."""
    return F.when(F.col("failed") > 0, "failed").when(F.col("pending") + F.col("in_progress") > 0, "running").otherwise("completed")


def confidence(valid: Column, repaired: Column, quality: Column, used: Column, limit: Column) -> Column:
    """The mean of four parts in [0, 1], to three decimals."""
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    spare = F.greatest(F.lit(0.0), 1 - F.least(used / limit, F.lit(1.0)))
    return F.round((F.when(valid, 1.0).otherwise(0.0) + F.when(repaired, 0.7).otherwise(1.0) + clip(quality / 100) + spare) / 4, 3)


def provenance_errors(df: DataFrame) -> Column:
    ok = {
        "confidence": F.col("confidence").between(0, 1),
        "page_order": F.col("page_from") <= F.col("page_to"),
        "page_range": F.col("page_from").isNotNull() & F.col("page_to").isNotNull(),
        "source_doc": F.length("source_doc") > 0,
    }
    return F.array_sort(F.array_compact(F.array(*[F.when(~F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in ok.items()])))


def run_backend(items: DataFrame, backend: Callable[[pd.DataFrame], pd.DataFrame], schema: str, concurrency: int | None = None) -> DataFrame:
    """Rows that a backend makes of batches of items. Calls may be repeated when a task is, so results are keyed by item."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield backend(batch)

    return (items.repartition(concurrency, "item_id") if concurrency else items).mapInPandas(call, schema)


def offline_rules(batch: pd.DataFrame) -> pd.DataFrame:
    """The offline backend: numbers with units and severity words found by patterns, one row for each item."""
    values = batch["content"].str.count(r"\d+(?:\.\d+)?\s?(?:mm|cm|V|A|W|Hz|kg|psi|°C)\b")
    severe = batch["content"].str.contains(r"\b(?:danger|warning|caution)\b", case=False, regex=True)
    return pd.DataFrame({"item_id": batch["item_id"], "values": values.astype("int64"), "severe": severe, "words": batch["content"].str.split().str.len().astype("int64")})


def replayed(answers: dict[str, str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A backend that gives recorded answers by the SHA-256 of the prompt; an error where none was recorded."""

    def backend(batch: pd.DataFrame) -> pd.DataFrame:
        keys = [hashlib.sha256(p.encode()).hexdigest() for p in batch["prompt"]]
        found = [answers.get(k) for k in keys]
        return pd.DataFrame({"item_id": batch["item_id"], "response": found, "error": [None if x is not None else "no recorded answer" for x in found]})

    return backend


def with_repair(ask: Callable[[str], str], schema: dict, attempts: int = 2) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A backend that asks for JSON by a schema; answers that don't satisfy it are asked for again, then by the relaxed schema.

    What satisfies the relaxed schema counts only if it satisfies the strict one too. Else an item is flagged for review.
    """

    def tried(prompt: str) -> tuple[str | None, str | None]:
        try:
            raw = ask(prompt)
            errors = json_errors(json.loads(raw), schema)
        except ValueError as e:
            return None, str(e)
        return (raw, None) if not errors else (None, "; ".join(errors))

    def backend(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for item, prompt in zip(batch["item_id"], batch["prompt"], strict=True):
            raw, error = tried(prompt)
            strategy, used, errors = "direct", 0, [] if error is None else [error]
            ladder = (("reprompt", "Answer again; the answer was invalid"), ("relaxed_schema", f"Answer by this schema: {json.dumps(relaxed_schema(schema), sort_keys=True)}; the answer was invalid"))
            for name, said in ladder[:attempts]:
                if raw is not None:
                    break
                used += 1
                raw, error = tried(f"{prompt}\n{said}: {error}")
                strategy = name
                if error is not None:
                    errors.append(error)
            rows.append((item, raw, "manual_review" if raw is None else strategy, used, errors, raw is None))
        return pd.DataFrame(rows, columns=["item_id", "response", "strategy", "attempts", "errors", "flagged"])

    return backend


REPAIRED = "item_id string, response string, strategy string, attempts int, errors array<string>, flagged boolean"
_JSON_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def json_errors(value: object, schema: dict, path: str = "$") -> list[str]:
    """What of a value a JSON schema forbids, sorted, each with its path: types, required, extra and enumerated values, bounds and items."""
    out: list[str] = []
    if "anyOf" in schema and all(json_errors(value, s, path) for s in schema["anyOf"]):
        out.append(f"{path}: fits none of the options")
    kinds = schema.get("type")
    if kinds is not None:
        listed = [kinds] if isinstance(kinds, str) else kinds
        fits = any(isinstance(value, _JSON_TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number")) or (k == "integer" and isinstance(value, float) and value.is_integer()) for k in listed)
        if not fits:
            return [*out, f"{path}: is not of type {' or '.join(listed)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: is not one of {schema['enum']}")
    if "const" in schema and value != schema["const"]:
        out.append(f"{path}: is not {schema['const']!r}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{path}: is too short")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{path}: does not match {schema['pattern']}")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{path}: is less than {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{path}: is greater than {schema['maximum']}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}: lacks {k}" for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{path}: has no place for {k}" for k in value if k not in known]
        for k, own in known.items():
            if k in value:
                out += json_errors(value[k], own, f"{path}.{k}")
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            out.append(f"{path}: has too few items")
        if isinstance(schema.get("items"), dict):
            for n, x in enumerate(value):
                out += json_errors(x, schema["items"], f"{path}[{n}]")
    return sorted(out)


def relaxed_schema(schema: object) -> object:
    """A JSON schema without the demands that an answer's form may miss."""
    # The keys that go.
    strict = ("required", "additionalProperties", "minItems", "maxItems", "minLength", "maxLength", "enum")
    if isinstance(schema, list):
        return [relaxed_schema(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    return {k: {n: relaxed_schema(x) for n, x in v.items()} if k == "properties" and isinstance(v, dict) else relaxed_schema(v) for k, v in schema.items() if k not in strict}


def retry_hint(message: Column) -> Column:
    """Seconds that an error message asks to wait, 0 if none."""
    m = F.lower(message)
    pattern = r"try again in ([0-9]+(?:\.[0-9]+)?)\s*(ms|s)\b"
    value = F.regexp_extract(m, pattern, 1)
    return F.when(value == "", 0.0).otherwise(F.try_to_number(value, F.lit("9999999999.999999")).cast("double") / F.when(F.regexp_extract(m, pattern, 2) == "ms", 1000.0).otherwise(1.0))


def transient(message: Column, status: Column) -> Column:
    """Whether an error may pass by itself."""
    m = F.lower(message)
    return status.isin(429, 500, 503) | F.contains(m, F.lit("timeout")) | F.contains(m, F.lit("temporarily unavailable")) | F.contains(m, F.lit("rate limit"))


def file_name(x: Column) -> Column:
    """A name for files: everything but letters, digits, - and _ becomes -."""
    return F.regexp_replace(x, r"[^\p{L}\p{N}_-]", "-")


def nullable_schema(schema: object) -> object:
    """A JSON schema in which all properties are required, and those that weren't may be null."""

    def or_null(own: object) -> object:
        if not isinstance(own, dict):
            return own
        kinds = own.get("type")
        if kinds is not None:
            listed = [kinds] if isinstance(kinds, str) else list(kinds)
            return own if "null" in listed else own | {"type": [*listed, "null"]}
        options = own.get("anyOf")
        if isinstance(options, list) and {"type": "null"} not in [{"type": o.get("type")} for o in options if isinstance(o, dict)]:
            return own | {"anyOf": [*options, {"type": "null"}]}
        return own

    if isinstance(schema, list):
        return [nullable_schema(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: nullable_schema(v) for k, v in schema.items()}
    if isinstance(out.get("properties"), dict):
        needed = set(out.get("required") or ())
        out["properties"] = {k: v if k in needed else or_null(v) for k, v in out["properties"].items()}
        out["required"] = list(out["properties"])
    return out
