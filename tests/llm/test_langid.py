import numpy as np
from cases import docs
from daybook.llm import langid as L
from daybook.llm import queries
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.01"


def test_bind_is_the_product_of_rotated_letter_vectors():
    base = L.letter_vectors(64)
    g = (3 * L.LETTERS + 5) * L.LETTERS + 9
    want = np.roll(base[3], 2) * np.roll(base[5], 1) * base[9]
    assert (L.bind(np.array([g]), 64)[0] == want).all()


def test_grams_skip_what_is_no_letter():
    assert len(L.grams("12 ++ …")) == 0 and len(L.grams(None)) == 0
    assert (L.grams("Ab,  c") == L.grams("ab c")).all()
    assert len(L.grams("中文")) == 2


def test_prototypes_are_the_bundles_of_all_texts(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("aba cab", "x"), ("bab", "x"), ("zoz uz", "y"), (None, "y"), ("aa", None)])]
    p = L.fit(docs(spark, rows), dim=256)
    x = L.bundle("aba cab", 256) + L.bundle("bab", 256)
    y = L.bundle("zoz uz", 256)
    unit = np.array([v / np.linalg.norm(v) for v in (x, y)])
    assert p.langs == ["x", "y"] and np.allclose(p.centre, unit.mean(axis=0))
    assert p.score("cab bab")[0] == "x" and p.score("uz zoz")[0] == "y" and p.score("1 2") == ("und", 0.0)


def test_odd_rows(spark):
    d = docs(spark, clash=("told", "lang_pred", "score"))
    out = {r["doc_id"]: r["told"] for r in d.withColumn("told", L.predict(F.col("text"), L.fit(d))).collect()}
    assert out[2]["lang_pred"] == out[3]["lang_pred"] == out[4]["lang_pred"] == "und" and out[2]["score"] == 0
    assert out[6]["lang_pred"] == "fr" and 0 <= out[7]["score"] <= 1


def test_no_training_rows(spark):
    p = L.fit(docs(spark, []))
    assert p.langs == [] and p.score("text") == ("und", 0.0)


def test_held_out_accuracy(spark):
    got = queries.language_id(spark, SF_SMALL).join(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[1] > 100 and held[0] > 0.97
