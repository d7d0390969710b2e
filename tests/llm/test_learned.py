"""The two fitted models on small corpora of known kinds."""

import pytest
from conftest import SCHEMA, prose

from faultline.llm import langid, quality

KINDS = {"aa": ["thing", "other", "water", "house", "when"], "bb": ["żółw", "łąka", "gęś", "źdźbło", "ćma"], "cc": ["que", "para", "niño", "agua", "cuando"]}


def language_rows(n):
    names = sorted(KINDS)
    rows = [(i, prose(i, 5 + i % 60, KINDS[names[i % 3]]), names[i % 3], "s", 1) for i in range(n)]
    return rows + [(n, None, "aa", "s", 1), (n + 1, "", "bb", "s", 1), (n + 2, "12 + 34 !!", "cc", "s", 1), (None, prose(1, 9, KINDS["bb"]), "bb", "s", 1),
                   (n + 3, prose(2, 9, KINDS["cc"]), None, "s", 1), (0, rows[0][1], "aa", "s", 1)]


def test_languages(spark, nothing, clashing):
    rows = language_rows(600)
    got = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert 100 < len(held) < 200
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (600, 601, 602))
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(nothing).count() == 0
    assert langid.identify(clashing).count() == 14


def test_language_is_not_an_input_and_reruns_agree(spark):
    rows = language_rows(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    first = {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in langid.identify(docs).collect()}
    assert first == {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in langid.identify(docs.repartition(3)).collect()}
    one = [(i, prose(i, 20), "en", "s", 1) for i in range(20)]
    assert {r.lang_pred for r in langid.identify(spark.createDataFrame(one, SCHEMA)).collect()} == {"en"}
    assert {r.lang_pred for r in langid.identify(spark.createDataFrame([(1, "abc", None, "s", 1)], SCHEMA)).collect()} == {"und"}


LABELS = "doc_id long, quality int, toxic int, text string"


def quality_rows(n):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = prose(i, 40 + i % 200)
        if not good:
            text = " ".join(w + "###" for w in text.split()) if i % 8 else text.upper().replace(" ", "!! ")
        if i % 5 == 1:
            text = prose(i + 9000, 80) + " " + text
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(good), 0, "x"))
    return rows, labels


def test_quality(spark, nothing, clashing):
    rows, labels = quality_rows(800)
    rows += [(9000, None, None, None, None), (9001, "", "en", "s", 0), (None, "x", "en", "s", 1), (1, rows[1][1], "en", "s", 1)]
    labels += [(9000, None, None, None), (None, 1, 0, None), (55555, 1, 0, None)]
    marks = spark.createDataFrame(labels, LABELS)
    got = quality.classify(spark.createDataFrame(rows, SCHEMA), marks).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 800]
    truth = {d: q for d, q, _, _ in labels}
    assert 100 < len(held) < 240
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert quality.classify(nothing, marks).count() == 0
    assert quality.classify(clashing, marks).count() == 14
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.classify(spark.createDataFrame(rows[:5], SCHEMA), none).collect()} == {0.5}


def test_gradient_of_the_attention_model():
    import numpy as np

    draw = np.random.default_rng(0)
    x = draw.normal(0, 1, (7, quality.WIDTH))
    starts, of, y = np.array([0, 3, 4]), np.array([0, 0, 0, 1, 2, 2, 2]), np.array([1.0, 0.0, 1.0])
    model = quality.Model.new(x)

    def loss():
        z = model.forward(x, starts, of)["logit"]
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    f = model.forward(x, starts, of)
    grad = model.gradient(f, 1 / (1 + np.exp(-f["logit"])) - y, starts, of)
    for name, w in model.layers.items():
        for at in list(np.ndindex(w.shape))[:: max(1, w.size // 5)]:
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_passages_of_a_long_text():
    text = " ".join(prose(i, 2500) for i in range(90))
    bags = quality.passages(text)
    assert bags.shape == (-(-len(text.split()) // quality.PASSAGE), quality.WIDTH)
    assert (quality.passages(None) == 0).all() and quality.passages("a").shape[0] == 1


def test_sample_of_many_labels(spark):
    """Rare labels keep their share beside frequent ones, however many there are."""
    from faultline.llm.sampling import bounded

    rows = [(i, f"big{i % 25}") for i in range(50_000)] + [(100_000 + i, f"rare{i % 5}") for i in range(1000)]
    got = bounded(spark.createDataFrame(rows, "id long, label string"), "label", "id", 400, 3000, "x").groupBy("label").count().collect()
    assert len(got) == 30 and {r["count"] for r in got} == {100}
    few = bounded(spark.createDataFrame(rows[:60], "id long, label string"), "label", "id", 400, 3000, "x")
    assert few.count() == 60
