import random
import numpy as np

from tarn.llm import language


def test_held_out_accuracy(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    rows = language.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_label_source_and_id_are_no_inputs(spark, sf_dir, documents):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(df)
    from pyspark.sql import functions as F

    blind = df.select("doc_id", "text", F.lit("xx").alias("lang"), F.lit("q").alias("source"), "n_chars")
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, model).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(blind, model).collect()}
    assert one == two


def test_edges(documents, clashing):
    train = [(i, t, lang) for i in range(60) for t, lang in [("the cat and the dog were here", "en"), ("der hund und die katze sind hier", "de")]]
    rows = train + [(1000, None), (1001, ""), (1002, "12 34 !?"), (1003, "und die katze " * 20_000), (None, "the dog")]
    got = {r.doc_id: r for r in language.identify(clashing(documents(rows))).collect() if r.doc_id is None or r.doc_id >= 1000}
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(got[i].rejected and got[i].score == 0 for i in (1000, 1001, 1002))
    assert got[1003].lang_pred == "de" and got[None].lang_pred == "en" and not got[None].held_out
    assert language.identify(documents(rows).limit(0)).collect() == []
    assert {r.lang_pred for r in language.identify(documents([(1, "no labels at all")])).collect()} == {"und"}


def test_keep_known(documents, clashing):
    train = [(i, t, lang) for i in range(60) for t, lang in [("the cat and the dog were here", "en"), ("der hund und die katze sind hier", "de")]]
    df = clashing(documents([*train, (1000, None), (1001, "123")]))
    out = language.keep_known(df)
    assert out.columns == df.columns and out.count() == len(train)


def test_texts_are_predicted_alike_alone_and_in_a_batch():
    rng = np.random.default_rng(0)
    model = language.Model(["a", "b"], rng.normal(size=(language.BUCKETS, 2)), np.zeros(2))
    texts = ["one two", "", None, "x", "three four five"]
    together = model.logits(texts)
    for i, t in enumerate(texts):
        assert np.allclose(model.logits([t])[0], together[i])


def test_other_languages_are_rejected_whatever_the_number_of_rows_or_languages(spark, sf_dir):
    of = {}
    for r in spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").where("lang is not null and length(text) between 200 and 8000").orderBy("doc_id").collect():
        of.setdefault(r.lang, []).append(r.text)
    for known, other, n in ((["en"], "es", 30), (["en"], "es", 80), (["es", "fr"], "de", 60), (["de", "en"], "es", 100)):
        model = language.fit([(t, lang) for lang in known for t in of[lang][:n]])
        rejected = lambda lang: np.mean([s < model.threshold for s in model.predict(of[lang][-60:])[1]])  # noqa: B023, E731
        assert rejected(other) > 0.5 and max(map(rejected, known)) < 0.05, (known, n)


def test_a_language_of_long_texts_only(documents):
    rng = random.Random(8)
    say = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    rows = [(i, say("abcdefg", 2500), "xa") for i in range(30)] + [(100 + i, say("rstuvwy", 60), "xb") for i in range(60)]
    model = language.train(documents(rows))
    assert model.languages == ["und", "xa", "xb"] or model.languages == ["xa", "xb", "und"]
    assert model.predict([say("abcdefg", 40), say("rstuvwy", 40)])[0] == ["xa", "xb"]
    assert all(len(t) <= language.SAMPLE_CHARS for t, _ in language.sample(documents(rows)))


def test_the_sample_does_not_depend_on_partitions(spark, documents):
    rows = [(i, f"text number {i} of many", "xa" if i % 3 else "xb") for i in range(3000)]
    df = documents(rows)
    assert language.sample(df, 50) == language.sample(df.repartition(7, "text"), 50) and 60 < len(language.sample(df, 50)) <= 200


def test_the_threshold_keeps_right_predictions_and_scores_are_calibrated():
    rng = random.Random(9)
    say = lambda letters, n=30: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    kinds = {"xa": "abcdefghij", "xb": "fghijklmno", "xc": "klmnopqrst"}
    model = language.fit([(say(letters), lang) for lang, letters in kinds.items() for _ in range(200)])
    fresh = [(say(letters), lang) for lang, letters in kinds.items() for _ in range(200)]
    found, score = model.predict([t for t, _ in fresh])
    right = [a == b for a, (_, b) in zip(found, fresh, strict=True)]
    assert sum(right) > 0.97 * len(right)
    assert sum(s < model.threshold for s, ok in zip(score, right, strict=True) if ok) <= 0.05 * len(right)
    assert abs(sum(score) / len(score) - sum(right) / len(right)) < 0.1
    _, unknown = model.predict([say("αβγδεζηθικ") for _ in range(100)])
    assert sum(s < model.threshold for s in unknown) >= 90
