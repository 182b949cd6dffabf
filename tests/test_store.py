import json
import zlib

import pytest
from pyspark.sql import functions as F

from lodestack.operators import extraction, records
from lodestack.sources import packs, pdf, store
from lodestack.streaming import logs

R = "doc_id string, section_id string, record_type string, record_id string"


def test_units_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "records")
    df = lambda *rows: spark.createDataFrame(list(rows), R)
    held = lambda **more: sorted(r.record_id for r in store.read_units(spark, path, store.RECORDS, **more).collect())
    store.write_units(df(("d", "s", "spec", "1"), ("d", "s", "spec", "2"), ("d", "t", "spec", "3"), ("e", "s", "spec", "4")), path, store.RECORDS, 1)
    for _ in range(2):  # again, as after a crash
        store.write_units(df(("d", "s", "spec", "9")), path, store.RECORDS, 2, units=df(("d", "s", "spec", ""), ("d", "t", "spec", "")))
        assert held() == ["4", "9"] and held(upto=1) == ["1", "2", "3", "4"]
    store.compact(spark, path, store.RECORDS, str(tmp_path / "small"))
    assert sorted(r.record_id for r in store.read_units(spark, str(tmp_path / "small"), store.RECORDS).collect()) == ["4", "9"]


def test_checkpoints_are_the_last_events(spark):
    events = spark.createDataFrame([("r", "a", 1, "pending"), ("r", "a", 3, "succeeded"), ("r", "a", 2, "in_progress"), ("r", "b", 1, "pending")], "run_id string, item_id string, at long, status string")
    assert {r.item_id: r.status for r in store.latest_states(events).collect()} == {"a": "succeeded", "b": "pending"}


def test_artifacts(spark, tmp_path):
    path = str(tmp_path)
    store.write_artifact(spark.createDataFrame([("d", 90.5), ("e", 1.0)], "doc_id string, overall double"), path, "quality")
    store.write_artifact(spark.createDataFrame([("d", 70.0)], "doc_id string, overall double"), path, "quality")
    assert {r.doc_id: r.overall for r in store.read_artifact(spark, path, "quality", "overall double").collect()} == {"d": 70.0, "e": 1.0}
    with pytest.raises(FileNotFoundError, match="headings"):
        store.read_artifact(spark, path, "headings", "x string")


def test_yaml_and_pages(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    rows = spark.createDataFrame([("d", "Größe: 3", None, ["x"], 7)], "doc_id string, title string, gone string, models array<string>, computed int")
    text = store.yaml_texts(rows, "doc_id", ("computed",)).first().text
    assert yaml.safe_load(text) == {"doc_id": "d", "title": "Größe: 3", "models": ["x"]} and text.startswith("doc_id: d")
    store.write_texts(store.yaml_texts(rows, "doc_id"), str(tmp_path / "manifests"), "doc_id")
    assert "Größe" in next((tmp_path / "manifests" / "doc_id=d").glob("*.txt")).read_text()
    page = store.page_texts(spark.createDataFrame([("p.md", "A: b", "Body\n")], "path string, title string, body string"), ["title"]).first().text
    assert page == "---\ntitle: 'A: b'\n---\nBody\n"


def test_publish_leaves_a_manifest_and_first_sources(spark, tmp_path):
    staged = spark.createDataFrame([("b.md", "2"), ("a.md", "1")], "path string, digest string")
    sources = spark.createDataFrame([("d", 2, "second"), ("d", 1, "first")], "doc_id string, ordinal int, title string")
    for _ in range(2):
        store.publish(staged, sources, str(tmp_path / "out"), "v1")
    told = json.loads(spark.read.text(str(tmp_path / "out" / "manifest")).first().value)
    assert told == {"version": "v1", "count": 2, "files": [{"path": "a.md", "digest": "1"}, {"path": "b.md", "digest": "2"}]}
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "out" / "_sources")).select("doc_id", "title").collect()] == [("d", "first")]


def test_packs(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "pack.yaml").write_text("source_dir: files\ndocuments:\n- filename: a.pdf\n  revision: 2\n- filename: b.pdf\n  include: conditional\n- filename: c.pdf\n")
    pack = packs.source_pack(spark, str(tmp_path / "pack.yaml"))
    assert [r.filename for r in packs.selected(pack).orderBy("ordinal").collect()] == ["a.pdf", "c.pdf"] and packs.selected(pack, True).count() == 3
    assert pack.first().path == str(tmp_path / "files" / "a.pdf") and pack.first().revision == "2"
    assert sorted(r.filename for r in packs.missing_files(pack, spark.createDataFrame([("file:/x/a.pdf",)], "path string")).collect()) == ["b.pdf", "c.pdf"]
    (tmp_path / "list.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        packs.load_yaml(str(tmp_path / "list.yaml"))


def test_settings(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "s.yaml").write_text("default_model: m\nrate_limit:\n  max_requests_per_minute: 5\nstages:\n  normalize:\n    language: deu\n    bypass_document_types: [a]\n  parse:\n    quality_threshold: 80\n")
    own = packs.settings(str(tmp_path / "s.yaml"), {"LODESTACK_MAX_TOKENS": "7", "LODESTACK_RATE_LIMIT_MAX_TOKENS_PER_MINUTE": "9"})
    assert own["max_tokens"] == 7 and own["rate_limit"] == {"max_requests_per_minute": 5, "max_tokens_per_minute": 9} and own["default_model"] == "m"
    found = packs.normalization(str(tmp_path / "s.yaml"))
    assert found["language"] == "deu" and found["bypass_document_types"] == ("a",) and found["deskew"] is True and packs.normalization("nowhere") == packs.NORMALIZATION
    assert packs.quality_gate(str(tmp_path / "s.yaml")) == 80.0 and packs.quality_gate("nowhere") == 70.0


def pdf_file(*contents):
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Count %d /MediaBox [0 0 612 792] /Kids [%s] >>" % (len(contents), b" ".join(b"%d 0 R" % (3 + 2 * k) for k in range(len(contents))))]
    for k, own in enumerate(contents):
        packed = zlib.compress(own)
        objects.append(b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R %s >>" % (4 + 2 * k, b"/MediaBox [0 0 36 144]" if k == 1 else b""))
        objects.append(b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(packed), packed))
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % (n, o) for n, o in enumerate(objects, 1))


def test_pdf_pages(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(pdf_file(b"BT /F1 12 Tf (re S f) Tj ET", b"0 0 10 10 re f % (x) Tj", b"", b"BT [(a) 3 (b)] TJ ET 1 0 m 2 2 l S"))
    (tmp_path / "b.pdf").write_bytes(b"no pdf")
    got = [(r.page, r.width_inches, r.height_inches, r.has_text, r.has_vector) for r in pdf.pages(spark, str(tmp_path)).orderBy("page").collect()]
    assert got == [(1, 8.5, 11.0, True, False), (2, 1.0, 2.0, False, True), (3, 8.5, 11.0, False, False), (4, 8.5, 11.0, True, True)]


def test_json_errors_name_paths():
    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"type": "array", "items": {"type": ["string", "null"], "minLength": 1}}, "c": {"enum": ["x"]}}}
    assert extraction.json_errors({"a": 1, "b": ["x", None], "c": "x"}, schema) == []
    assert extraction.json_errors({"a": 0, "b": ["", 3], "c": "y", "d": 1}, schema) == ["$.a: is less than 1", "$.b[0]: is too short", "$.b[1]: is not of type string or null", "$.c: is not one of ['x']", "$: has no place for d"]
    assert extraction.json_errors([], schema) == ["$: is not of type object"] and extraction.json_errors({}, schema) == ["$: lacks a"]


def test_repair_ladder_and_replay(spark):
    import hashlib

    schema = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}}

    def ask(prompt):
        if "good" in prompt:
            return '{"n": 1}'
        if "twice" in prompt and "Answer again" in prompt or "later" in prompt and "by this schema" in prompt:
            return '{"n": 2}'
        return '{"m": 0}' if "never" in prompt else "no JSON"

    prompts = spark.createDataFrame([(p, p) for p in ("good", "twice", "later", "never")], "item_id string, prompt string")
    got = {r.item_id: (r.strategy, r.attempts, r.flagged, r.response) for r in extraction.run_backend(prompts, extraction.with_repair(ask, schema), extraction.REPAIRED).collect()}
    assert got == {"good": ("direct", 0, False, '{"n": 1}'), "twice": ("reprompt", 1, False, '{"n": 2}'), "later": ("relaxed_schema", 2, False, '{"n": 2}'), "never": ("manual_review", 2, True, None)}
    answers = {hashlib.sha256(b"good").hexdigest(): "yes"}
    told = {r.item_id: (r.response, r.error) for r in extraction.run_backend(prompts, extraction.replayed(answers), "item_id string, response string, error string").collect()}
    assert told["good"] == ("yes", None) and told["never"] == (None, "no recorded answer")


def test_batches_end_where_the_model_changes(spark):
    rows = [(1, n, 10, m) for n, m in enumerate("aabbbba")] + [(1, 7, 500, "a"), (1, 8, 1, "a")]
    got = extraction.chunks(spark.createDataFrame(rows, "run long, n long, tokens long, model string"), "run", "n", most=3, budget=100).collect()
    assert [r.chunk for r in sorted(got, key=lambda r: r.n)] == [0, 0, 1, 1, 1, 2, 3, 4, 5]


def test_retry_classes_and_routes(spark):
    messages = ["HTTP 429", "error 4290", "Too Many Requests", "Rate limit reached", "timeout", None]
    df = spark.createDataFrame([(m, "procedure", "safety", 5) for m in messages], "m string, record_type string, section_type string, prompt_tokens long")
    rules = [{"retry_class": "rate_limit", "model": "small"}, {"max_tokens": 5, "record_types": ["procedure"], "model": "mid"}]
    got = extraction.route(df.withColumn("retry_class", extraction.retry_class(F.col("m"))), rules, "usual").collect()
    assert [r.model for r in got] == ["small", "mid", "small", "small", "mid", "mid"]


def test_shared_pauses_in_a_stream(spark, tmp_path):
    schema = "run string, item_id string, at double, tokens long, pause double"
    rows = [("r", "a", 0.0, 60, 0.0), ("r", "b", 1.0, 60, 0.0), ("r", "c", 2.0, 500, 0.0), ("s", "x", 0.0, 1, 0.0), ("s", "!", 0.0, 0, 15.0), ("s", "y", 1.0, 1, 0.0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = logs.dispatched(spark.readStream.schema(schema).json(str(tmp_path / "in")), requests=5, budget=100)
    logs.drain(stream, str(tmp_path / "check"), logs.keyed_sink(out, ("run", "item_id")))
    got = {(r.run, r.item_id): r.starts_at for r in store.read_units(spark, out, ("run", "item_id")).collect()}
    assert got == {("r", "a"): 0.0, ("r", "b"): 60.0, ("r", "c"): None, ("s", "x"): 15.0, ("s", "y"): 15.0}


def test_known_checksums_are_skipped_in_a_stream(spark, tmp_path):
    schema = "checksum string, ts timestamp"
    spark.sql("SELECT * FROM VALUES ('a', timestamp'2024-01-01'), ('b', timestamp'2024-01-01'), ('b', timestamp'2024-01-01') AS t(checksum, ts)").coalesce(1).write.json(str(tmp_path / "in"))
    found = []
    stream = logs.unseen(spark.readStream.schema(schema).json(str(tmp_path / "in")), spark.createDataFrame([("a",)], "checksum string"))
    logs.drain(stream, str(tmp_path / "check"), lambda batch, _: found.extend(r.checksum for r in batch.collect()))
    assert found == ["b"]


def test_sections_of_record_ids(spark):
    df = spark.createDataFrame([("d--title--abc--spec_value--001",), ("a--b",), ("plain",)], "record_id string")
    assert [r.s for r in df.select(records.section_of_record(F.col("record_id")).alias("s")).collect()] == ["d--title--abc", "a", "plain"]


def test_raw_parser_output(spark):
    from lodestack.sources import raw_parse

    raw = {
        "texts": [{"self_ref": "#/0", "label": "title", "text": "T", "prov": [{"page_no": 2}, {"page_no": 1}, {"page_no": 2}, {"page_no": "3"}]}, {"text": 5}],
        "tables": [{"self_ref": "#/t", "data": [["a"], ["b", 2]]}, {"data": "none"}],
        "pages": {"1": {"page_no": 1, "size": {"width": 612, "height": 792}}, "x": {"page_no": "2"}, "y": 3},
    }
    rows = [("d", json.dumps(raw), None), ("e", json.dumps({"pages": [{"page_no": 7}]}), 9), ("f", "{}", 4), ("g", "no JSON", None)]
    got = {r.doc_id: r for r in raw_parse.normalized_structures(spark.createDataFrame(rows, "doc_id string, raw string, told_pages int")).collect()}
    assert [(t.self_ref, t.label, t.text, t.pages) for t in got["d"].texts] == [("#/0", "title", "T", [2, 1]), (None, "", "5", [])]
    assert [t.data for t in got["d"].tables] == [[["a"], ["b", "2"]], []]
    assert {k: r.page_count for k, r in got.items()} == {"d": 3, "e": 1, "f": 4, "g": 0}
    assert [(p.page, p.width) for p in got["d"].pages] == [(1, 612.0)] and [(p.page, p.width) for p in got["e"].pages] == [(7, None)]


def test_heads_with_lists(spark, tmp_path):
    pytest.importorskip("yaml")
    from lodestack.sources import files

    (tmp_path / "a.md").write_text("---\ntitle: A\ntags:\n- x\n- y\n---\nBody\n")
    (tmp_path / "b.md").write_text("No head\n")
    got = {r.path[-4:]: r for r in files.heads(files.pages(spark, str(tmp_path)), "title string, tags array<string>").collect()}
    assert got["a.md"].tags == ["x", "y"] and got["a.md"].body == "Body\n" and got["b.md"].title is None


def test_checksum_index(spark, tmp_path):
    path = str(tmp_path / "index")
    assert store.load_checksum_index(spark, path).count() == 0
    manifests = spark.createDataFrame([("c1", "d1", "a.yaml"), ("c1", "d2", "b.yaml"), ("c2", "d3", "c.yaml")], "checksum string, doc_id string, path string")
    for _ in range(2):
        store.save_checksum_index(store.checksum_index(manifests), path)
    assert sorted(map(tuple, store.load_checksum_index(spark, path).collect())) == [("c1", "d2"), ("c2", "d3")]


def test_checksum_index_counts_copies(spark):
    manifests = spark.createDataFrame([("c1", "d1", "a"), ("c1", "d2", "b"), ("c2", "d3", "c")], "checksum string, doc_id string, path string")
    assert sorted((r.checksum, r.doc_id, r.copies) for r in store.checksum_index(manifests).collect()) == [("c1", "d2", 2), ("c2", "d3", 1)]


def test_truncations(spark):
    df = spark.createDataFrame([(["a"] * 7, "x" * 300), (["a"] * 5, "y")], "t array<string>, m string")
    got = df.select(records.first_suppressed(F.col("t")).alias("t"), F.length(records.error_snippet(F.col("m"))).alias("n")).collect()
    assert [(r.t, r.n) for r in got] == [(["a"] * 5 + ["and 2 more"], 200), (["a"] * 5, 1)]


def files_read(df):
    """Files that the scans of a plan have opened, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(int(leaves.apply(k).metrics().apply("numFiles").value()) for k in range(leaves.size()))


def test_one_unit_is_read_from_one_bucket(spark, tmp_path):
    schema = "doc_id string, section_id string, record_type string, record_id string"
    rows = lambda n, v: spark.createDataFrame([(f"d{k}", "s", "spec", f"{v}-{k}-{j}") for k in range(n) for j in range(2)], schema)
    path = str(tmp_path / "records")
    store.write_units(rows(300, 1), path, store.RECORDS, 1)
    store.write_units(rows(40, 2), path, store.RECORDS, 2, units=spark.createDataFrame([("d299", "s", "spec")], "doc_id string, section_id string, record_type string"))
    unit = lambda d: {"doc_id": d, "section_id": "s", "record_type": "spec"}
    got = {d: sorted(r.record_id for r in store.read_unit(spark, path, unit(d), schema).collect()) for d in ("d7", "d200", "d299", "none")}
    assert got == {"d7": ["2-7-0", "2-7-1"], "d200": ["1-200-0", "1-200-1"], "d299": [], "none": []}
    assert files_read(store.read_unit(spark, path, unit("d7"), schema)) == 1
    assert store.read_units(spark, path, store.RECORDS, schema=schema).count() == 2 * 299
    assert store.read_units(spark, path, store.RECORDS, upto=1, schema=schema).count() == 600


def test_the_first_missing_artifact_is_named(spark, tmp_path):
    path = str(tmp_path)
    store.write_artifact(spark.createDataFrame([("d", 1.0)], "doc_id string, overall double"), path, "quality")
    with pytest.raises(FileNotFoundError, match="headings"):
        store.read_artifacts(spark, path, {"quality": "overall double", "tables": "x string", "headings": "x string"})
    assert store.read_artifacts(spark, path, {"quality": "overall double"})["quality"].count() == 1
