import zlib

from pyspark.sql import functions as F

from lodestack.llm import langid


def test_held_out_accuracy(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = langid.predict(docs, langid.train(docs)).join(docs, "doc_id").where(langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = found.collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows(edge):
    for r in edge.select("doc_id", langid.held_out(F.col("doc_id")).alias("out")).collect():
        assert r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_edges(edge, nothing):
    model = langid.train(edge)
    assert set(model.languages) <= {"de", "en"}
    got = langid.predict(edge, model).join(edge.select("doc_id", "text").distinct(), "doc_id").collect()
    for r in got:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letter and 0 <= r.score <= 1 and (letter or r.score == 0)
    assert langid.predict(nothing, model).count() == 0
    untaught = langid.predict(edge, langid.train(nothing)).collect()
    assert {r.lang_pred for r in untaught} == {"und"}
    kept = langid.keep_languages(edge, model, 0.0).collect()
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in edge.collect() if model.predict(r.text)[1] > 0)


def test_texts_of_no_learned_language_go(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.train(docs)
    least = langid.least_score(docs, model)
    assert 0 < least < 0.5
    odd = spark.createDataFrame([(1, "\u4eca\u65e5\u306f\u826f\u3044\u5929\u6c17\u3067\u3059"), (2, "\u0441\u0435\u0433\u043e\u0434\u043d\u044f \u0445\u043e\u0440\u043e\u0448\u0430\u044f"), (3, "12 !"), (4, None)], "doc_id long, text string")
    assert langid.keep_languages(odd, model, least).count() == 0
    clean = docs.where("lang IS NOT NULL AND n_chars > 200").select("doc_id", "text")
    assert langid.keep_languages(clean, model, least).count() == clean.count()


def plain_distance(text, profiles, size):
    """The method word by word: counts in a dict, ranks by count and code, sums of differences."""
    counts = {}
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for w in words:
        padded = [1, *[ord(c) + 2 for c in w], 1]
        grams = [(x,) for x in padded[1:-1]] + list(zip(padded, padded[1:])) + list(zip(padded, padded[1:], padded[2:]))
        for g in grams:
            code = 0
            for x in g:
                code = code << 21 | x
            counts[code] = counts.get(code, 0) + 1
    own = sorted(counts, key=lambda c: (-counts[c], c))[:size]
    return {lang: sum(abs(p.index(c) - k) if c in p else size for k, c in enumerate(own)) for lang, p in profiles.items()}, len(own)


def test_distance_like_plain():
    texts = {"x": "the cat sat on the mat and the hat", "y": "le chat est sur la table et le chapeau"}
    profiles = {k: [int(c) for c in langid.ranked(langid.ngram_codes(t), 40)] for k, t in texts.items()}
    model = langid.Model(profiles, 40)
    for text in ("the chat", "la hat, le mat!", "Ein Hut", "cat 1 sat"):
        apart, n = plain_distance(text, profiles, 40)
        best = min(sorted(apart), key=apart.get)
        lang, score = model.predict(text)
        assert lang == best and abs(score - (1 - apart[best] / (40 * n))) < 1e-12


def test_out_of_place_distance():
    model = langid.Model({"x": [5, 6, 7], "y": [9]}, 3)
    codes = langid.ngram_codes("a a b")
    assert langid.ranked(codes, 1)[0] == ord("a") + 2
    assert model.predict("…")[0] == "und"
    assert langid.Model({}, 3).predict("abc") == ("und", 0.0)


def test_all_labelled_documents_are_learned_from(spark, monkeypatch):
    """Profiles are those of a plain count of all of them, however often a task sends what it holds; so is the least score."""
    import numpy as np

    monkeypatch.setattr(langid, "_AT_ONCE", 500)
    rows = [(k, f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} und {'abc' * (k % 5)}", "de") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.train(docs)
    taught = [t for d, t, _ in rows if zlib.crc32(str(d).encode()) % 4 != 2]
    profile = langid.ranked(np.concatenate([langid.ngram_codes(t) for t in taught]), langid.PROFILE)
    plain = langid.Model({"de": [int(c) for c in profile]}, langid.PROFILE)
    assert (model.codes == plain.codes).all() and (model.ranks == plain.ranks).all()
    lowest = sorted(plain.predict(t)[1] for t in taught)[-(-len(taught) // 100) - 1]
    assert 0 <= langid.FOREIGN * lowest - langid.least_score(docs, model) < 1 / langid._STEPS
