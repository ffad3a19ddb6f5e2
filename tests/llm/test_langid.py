import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import langid

SCHEMA = "doc_id long, text string, lang string, score int, lang_pred string"
SMALL = langid.Options(docs_per_language=60, windows_per_doc=3, batch=96, steps=60, window=64)
WORDS = {"en": ["the", "and", "with", "shall", "through"], "de": ["und", "größe", "nicht", "über", "schön"], "fr": ["été", "où", "leçon", "vous", "très"]}


def sentences(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(sorted(WORDS))
        rows.append((i, " ".join(r.choices(WORDS[lang], k=r.randint(3, 60))), lang, 1, "x"))
    return rows


@pytest.mark.parametrize("lengths", [[7, 7, 5, 1], [4, 3, 3, 2]])
def test_gradient(lengths):
    """Backpropagation through time against differences, in double precision."""
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in langid.init(3, 4, 1).items()}
    windows = [bytes(rng.integers(97, 103, n, dtype=np.uint8)) for n in lengths]
    data, sizes = langid.pad(windows)
    labels = np.array([0, 2, 1, 1])
    _, grad = langid.loss_and_gradient(p, data, sizes, labels)
    for name, value in p.items():
        for at in [tuple(rng.integers(0, n) for n in value.shape) for _ in range(12)] + [(0, 97, 1) if name == "x" else tuple(0 for _ in value.shape)]:
            keep, e = value[at], 1e-4
            value[at] = keep + e
            up, _ = langid.loss_and_gradient(p, data, sizes, labels)
            value[at] = keep - e
            down, _ = langid.loss_and_gradient(p, data, sizes, labels)
            value[at] = keep
            assert grad[name][at] == pytest.approx((up - down) / (2 * e), abs=2e-4), name


def test_both_directions_reach_every_position():
    p = langid.init(2, 4, 3)
    data, sizes = langid.pad([b"abcdef"])
    base = langid.label_logits(p, data, sizes)
    for i in range(6):
        other = data.copy()
        other[i] = ord("z")
        changed = np.abs(langid.label_logits(p, other, sizes) - base).max(axis=2)[:, 0] > 0
        assert changed.all()


def test_padding_does_not_matter():
    p = langid.init(2, 4, 3)
    texts = [b"some text", b"a", b"another longer text than that"]
    together = langid.document_probabilities(p, texts, 8)
    alone = np.concatenate([langid.document_probabilities(p, [t], 8) for t in texts])
    assert np.allclose(together, alone, atol=1e-5) and np.allclose(together.sum(axis=1), 1, atol=1e-4)


def test_held_out_accuracy_and_edges(spark):
    rows = sentences(400, 1)
    rows += [(1000, None, "en", 1, "x"), (1001, "", "en", 1, "x"), (1002, "12 +-* 34\n", "de", 1, "x"), (1003, "the and " * 40_000, None, 1, "x"),
             (1004, "und", None, 1, "x"), (None, "où très été vous", None, 1, "x"), (1003, "the and " * 40_000, None, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(df, learn=~held, options=SMALL)
    assert model.languages == ("de", "en", "fr")
    got = model.predict(df, prefix="p_").withColumn("held", held).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "lang", "score", "lang_pred", "p_lang_pred", "p_score", "held"}
    tested = [r for r in got if r["held"] and r["doc_id"] < 1000]
    assert len(tested) > 40 and sum(r["p_lang_pred"] == r["lang"] for r in tested) / len(tested) > 0.97
    by_id = {r["doc_id"]: r["p_lang_pred"] for r in got}
    assert [by_id[i] for i in (1000, 1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "en", "de", "fr"]
    assert all(0 <= r["p_score"] <= 1 for r in got)
    again = langid.fit(df.repartition(3), learn=~held, options=SMALL)
    assert all(np.array_equal(again.weights[k], v) for k, v in model.weights.items())


def test_sample_is_bounded_and_skips_held_out_rows(spark):
    rows = sentences(500, 2) + [(2000 + i, "zzz zzz", "zz", 1, "x") for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    languages, windows, labels = langid.training_sample(df, "text", "lang", F.col("doc_id") != 2000, langid.Options(docs_per_language=32, windows_per_doc=4))
    assert languages == ["de", "en", "fr", "zz"] and len(windows) <= 4 * 32 * 4
    assert all(len(w) <= 64 for w in windows) and (labels == 3).sum() == 2


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "some text", None, 1, "x")], SCHEMA)
    model = langid.fit(df, options=SMALL)
    assert [tuple(r)[-2:] for r in model.predict(df, prefix="p_").collect()] == [("und", 0.0)]
    assert model.predict(df.where("false"), prefix="p_").count() == 0
