import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lodestack.operators import structure
from lodestack.sources import files


def test_raw_files(spark, tmp_path):
    (tmp_path / "My File.PDF").write_bytes(b"abc")
    r = files.raw_files(spark, str(tmp_path)).first()
    assert r.checksum == hashlib.sha256(b"abc").hexdigest() and r.raw_path.endswith(".pdf") and bytes(r.content) == b"abc"


def test_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("doc_id: x\npriority: 3\nother: 1\n")
    (tmp_path / "b.yaml").write_text("- no mapping\n")
    (tmp_path / "checksum-index.yaml").write_text("doc_id: index\n")
    got = {r.path.rsplit("/", 1)[1]: (r.doc_id, r.priority) for r in files.yaml_rows(spark, str(tmp_path), "doc_id string, priority int").collect()}
    assert got["a.yaml"] == ("x", 3) and got["b.yaml"][0] is None and len(got) == 2


def test_structures(spark, tmp_path):
    own = {"doc_id": "d", "page_count": 2, "texts": [{"self_ref": "#/0", "label": "text", "text": "hi", "pages": [1, 1, 2]}], "tables": [{"self_ref": "#/t", "pages": [1], "data": [["a"], ["b", "c"]]}, {"self_ref": "#/u"}]}
    (tmp_path / "s.json").write_text(json.dumps(own, indent=1))
    artifacts = files.structures(spark, str(tmp_path))
    assert files.text_items(artifacts).first().pages == [1, 2]
    assert [(r.rows, r.columns) for r in files.table_items(artifacts).orderBy("idx").collect()] == [(2, 2), (0, 0)]


def test_requests_and_results(spark, tmp_path):
    df = spark.createDataFrame([("a", "m", None), ("b", "m", "x")], files.REQUEST)
    files.write_requests(df, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"custom_id":"a","model":"m"}', '{"custom_id":"b","model":"m","body":"x"}']
    (tmp_path / "r.jsonl").write_text('{"custom_id":"a","status":200}\n\n[1]\nnot json\n')
    good, bad = files.read_results(spark, str(tmp_path / "r.jsonl"))
    assert [r.custom_id for r in good.collect()] == ["a"] and bad.count() == 2


def test_pages(spark, tmp_path):
    (tmp_path / "a.md").write_bytes(b"---\r\ntitle: \"A b\"\r\ntype: x\r\n---\r\nBody\r\n")
    (tmp_path / "b.md").write_text("No head\n")
    got = {r.path[-4:]: r for r in files.pages(spark, str(tmp_path)).withColumn("title", files.head_field(F.col("head"), "title")).collect()}
    assert got["a.md"].title == "A b" and got["a.md"].body == "Body\n" and got["b.md"]["head"] is None and got["b.md"].body == "No head\n"


def test_only_own_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    files.replace_partitions(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int"), path, ["k"])
    files.replace_partitions(spark.createDataFrame([("a", 9)], "k string, v int"), path, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 3)]


def test_provenance_overwrites_nested(spark):
    df = spark.createDataFrame([(["a"], ["b"])], "s array<string>, w array<string>")
    own = df.select(F.transform("s", lambda x: F.struct(x.alias("text"), F.lit("old").alias("provenance"))).alias("steps"), F.transform("w", lambda x: F.struct(x.alias("text"))).alias("warnings"))
    r = structure.with_provenance(own, F.struct(F.lit("d1").alias("doc"), F.lit(3).alias("page"))).first()
    assert r.provenance.doc == "d1" and r.steps[0].provenance.page == 3 and r.warnings[0].provenance.doc == "d1"


def test_table_functions_give_what_the_frames_give(spark):
    from pyspark.sql import functions as F

    from lodestack.operators import structure
    from lodestack.sources import files, table_functions

    texts = [None, "", " \n\n", "# A\n\nb\n \t\n## C d\n\n#e\n\n  #  f \n\n\n\ng\r\n\r\nh", "---\na: 1\n---\nBody\n\n# X", "---\r\nb: 2\r\n---\r\nrest", "---\nno end", "x\n\n####### y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table_functions.register(spark)
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    items = spark.sql("SELECT d.doc_id, i.idx, i.label, i.text, i.level FROM {docs} d, LATERAL markdown_items(d.text) i", docs=df).collect()
    assert key(items) == key(structure.markdown_items(df).collect()) and len(items) > 9
    head, body = files.frontmatter(F.col("text"))
    parts = spark.sql("SELECT d.doc_id, p.head, p.body FROM {docs} d, LATERAL page_parts(d.text) p", docs=df).collect()
    assert key(parts) == key(df.where("text IS NOT NULL").select("doc_id", head, body).collect())
