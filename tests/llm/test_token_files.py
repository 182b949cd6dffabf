import zlib

import numpy as np
import pyarrow.orc as orc
from tokenizers import Tokenizer

from lodestack.llm import token_files
from lodestack.llm.tokens import vocabulary


def test_files_hold_all_ids_in_order(spark, edge, edge_rows, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(edge, path, vocabulary(), partitions=3)
    library = Tokenizer.from_file(vocabulary())
    order = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for r in order:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        expected.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.with_checksums(token_files.read_tokens(spark, path))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected
    found = token_files.find_documents(spark, path, 4, 10)
    assert {r.doc_id for r in found.collect()} == {4, 7, 10}
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,4), LessThanOrEqual(doc_id,10)]" in found._jdf.queryExecution().toString()
    for file in (tmp_path / "ids").glob("*.orc"):
        ids = orc.ORCFile(file).read(["doc_id"]).column(0).to_pylist()
        assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_empty(spark, nothing, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(nothing, path, vocabulary())
    assert token_files.with_checksums(token_files.read_tokens(spark, path)).count() == 0


def test_other_vocabularies_are_encoded_whole(tmp_path):
    """A file whose pipeline isn't the known one gives what the library gives, even where words are joined."""
    import json

    import pyarrow as pa
    from tokenizers import Tokenizer

    from lodestack.llm import tokens

    own = json.loads(open(tokens.vocabulary(), encoding="utf-8").read())
    assert tokens.by_words(tokens.vocabulary())
    own["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": False}
    path = str(tmp_path / "other.json")
    (tmp_path / "other.json").write_text(json.dumps(own), encoding="utf-8")
    texts = ["Hello  world, it's 12 o'clock", None, "Größe\nund Maß"]
    library = Tokenizer.from_file(path)
    got = [ids for _, ids in tokens.encoded(pa.array(texts), path, 1)]
    assert got == [b"".join(x.to_bytes(4, "little") for x in [*library.encode(t or "", add_special_tokens=False).ids, 1]) for t in texts]


def test_files_have_stripes_row_indexes_and_bloom_filters(spark, tmp_path):
    """Looked up in the files themselves: streams of integers, and what the footers tell of columns."""
    import glob

    from pyarrow import orc

    from lodestack.llm import token_files
    from lodestack.llm.tokens import vocabulary

    rows = spark.createDataFrame([(k, f"word{k} " * (k % 50)) for k in range(3000)], "doc_id long, text string")
    path = str(tmp_path / "ids")
    token_files.write_tokens(rows, path, vocabulary())
    jvm = spark._jvm.org.apache
    bits = 0
    for name in glob.glob(f"{path}/*.orc"):
        reader = jvm.orc.OrcFile.createReader(jvm.hadoop.fs.Path(name), jvm.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
        for stripe in reader.getStripes():
            assert stripe.getIndexLength() > 0  # row indexes
            bits += 8 * stripe.getIndexLength()
    assert bits > 9 * 3000  # and Bloom filters: at 1 % false positives more than 9 bits a document
    found = spark.read.orc(path).where("doc_id = 1234")
    assert found.count() == 1 and "EqualTo(doc_id,1234)" in found._jdf.queryExecution().toString()
