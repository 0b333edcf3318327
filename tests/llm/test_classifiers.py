"""The three trained operators: held-out accuracy, no leak of held-out labels, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID
from shelfcast.llm import language, quality, toxicity
from shelfcast.llm.common import bounded_rows, labelled, hashed_parts, remainder

ODD = [(None, None), (None, "plain words"), (7, ""), (7, ""), (8, "x" * 200_000), (9, "!!! ??? 123"), (10, "日本語 ﬁ é")]
SCHEMA = "doc_id long, text string"


def tables(spark):
    return spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")


def held_out_accuracy(scored, labels, column):
    pdf = scored.where("held_out").join(labels, "doc_id").toPandas()
    assert len(pdf) > 30 and pdf.score.between(0, 1).all() and ((pdf.score >= 0.3) == (pdf.predicted == 1)).all()
    return (pdf.predicted == pdf[column]).mean()


def odd_docs(spark, rows=ODD):
    return spark.createDataFrame([(*r, 1, 0.5, True) for r in rows], SCHEMA + ", label int, score double, held_out boolean")


def check_odd(spark, classify):
    rows = classify(odd_docs(spark)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    same = [r for r in rows if r.doc_id == 7]
    assert same[0] == same[1]
    assert classify(odd_docs(spark).limit(0)).count() == 0


def test_toxicity(spark):
    docs, labels = tables(spark)
    held = remainder("doc_id", 4) == 2
    scored = toxicity.classify(docs, labels, held).cache()
    assert held_out_accuracy(scored, labels, "toxic") >= 0.92         # some 300 labels teach here
    lied = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in scored.collect()}
    assert all(abs(a[r.doc_id] - r.score) < 1e-9 for r in toxicity.classify(docs, lied, held).collect())
    check_odd(spark, lambda d: toxicity.classify(d, labels.unionByName(labels), held))
    one_class = labels.where("toxic = 0")
    assert toxicity.classify(docs, one_class, held).agg(F.max("score")).first()[0] < 0.3
    assert toxicity.classify(docs, labels.limit(0), held).count() == docs.count()


def test_grams_in_blocks_equal_grams_at_once(monkeypatch):
    text = "Some text, é and more " * 40
    whole = np.concatenate(list(toxicity.gram_blocks(text)))
    monkeypatch.setattr(toxicity, "BLOCK", 50)
    assert set(np.concatenate(list(toxicity.gram_blocks(text)))) == set(whole)      # presence is what counts


def test_quality(spark):
    docs, labels = tables(spark)
    held = remainder("doc_id", 5) == 0
    assert held_out_accuracy(quality.classify(docs, labels, held), labels, "quality") >= 0.95
    check_odd(spark, lambda d: quality.classify(d, labels, held))
    assert quality.classify(docs, labels.limit(0), held).count() == docs.count()


def test_compiled_rules_equal_plain_rules(spark):
    rng = np.random.default_rng(4)
    x = rng.random((600, len(quality.STATS)))
    y = ((x[:, 3] > .6) & (x[:, 5] <= .5) | (x[:, 1] > .9)).astype(float)
    model = quality.learn(x, y)
    assert model.rules
    z = model.bias + sum(w * quality.holds(rule, x) for rule, w in model.rules)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], list(quality.STATS))
    got = [r[0] for r in frame.select(model.compiled()).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-z))) and ((np.asarray(got) >= .5) == y).mean() > .97


def test_language(spark, monkeypatch):
    monkeypatch.setattr(language, "STEPS", 220)
    docs, _ = tables(spark)
    scored = language.classify(docs, remainder("doc_id", 3) == 1).withColumnRenamed("score", "p")
    pdf = scored.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (pdf.lang == pdf.lang_pred).mean() >= 0.97
    model = language.fit(docs, F.lit(True))
    got = {i: r for i, r in enumerate(language.identify(odd_docs(spark), model, "doc_id").collect())}
    assert [got[i].lang_pred == "und" for i in range(len(ODD))] == [True, False, True, True, False, True, False]
    nothing = language.classify(odd_docs(spark).withColumn("lang", F.lit(None).cast("string")), remainder("doc_id", 3) == 1)
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language.identify(odd_docs(spark).limit(0), model, "doc_id").count() == 0


def test_gru_gradients_match_differences():
    rng = np.random.default_rng(0)
    h, steps = language.HIDDEN, rng.integers(0, 256, (5, 3))
    table, u = rng.normal(0, .5, (3 * h, 256)), rng.normal(0, .5, (3 * h, h))
    weight = rng.normal(size=(5, h, 3))
    trace = []
    language.forward(table, u, steps, trace)
    d_table, d_u = language.backward(u, trace, weight)
    for target, grad, at in ((u, d_u, (4, 3)), (u, d_u, (17, 1)), (table, d_table, (2, steps[1, 0])), (table, d_table, (20, steps[0, 2]))):
        keep, values = target[at], []
        for shift in (1e-5, -1e-5):
            target[at] = keep + shift
            values.append((language.forward(table, u, steps) * weight).sum())
        target[at] = keep
        assert abs((values[0] - values[1]) / 2e-5 - grad[at]) < 1e-5


def test_rare_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "STEPS", 1)
    rare = [(i, "zz") for i in range(0, 40_000, 4000)]
    rows = [(i, "common words here", "en") for i in range(40_000) if i % 4000] + [(i, "rare qxqx jzjz", z) for i, z in rare]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True), sample=100)
    assert model.languages == ["en", "zz"]
    kept = hashed_parts(docs, "doc_id", "lang", 100, "language").groupBy("lang").count().collect()
    kept = {r.lang: r["count"] for r in kept}
    assert kept["zz"] == 10 and 50 <= kept["en"] <= 130


def test_one_id_on_a_third_of_the_rows_keeps_the_sample_bounded(spark):
    rows = [(i if i % 3 else 3, f"text {i}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, i % 2) for i in range(9000) if i % 3 or i == 3], "doc_id long, toxic int")
    every = labelled(spark, docs, labels, "toxic", F.lit(True), 20_000, "x")
    assert every.count() == 9000                                # fewer than the bound: all
    drawn = labelled(spark, docs, labels, "toxic", F.col("doc_id") < 100, 200, "x")     # 66 ids, one of them on 3000 rows
    assert 120 <= drawn.count() <= 300
    assert bounded_rows(docs, 9000).count() == 9000
