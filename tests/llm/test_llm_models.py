"""The co-trained classifier and the licence scanner on held-out rows."""

import random

import numpy as np
import pytest

from llm_cases import none, odd, odd_rows, rows_of, words
from opsframe.llm.cotraining import (
    Rows, ShortShapes, calibrate, fit, good_documents, logistic, meta_view,
    score, short_shape, text_view, train,
)
from opsframe.llm.licences import FAMILIES, TEMPLATES, licences, scan, similarity, words_of
from opsframe.llm.licences import fit as fit_licences

DATA = "/root/testdata/sf0.01"
MORE = "/root/testdata/sf0.1"


def test_shapes():
    assert short_shape(b"aaaaa!!!!") == b"aa!!"
    assert short_shape(b"") == b""
    one, two = (text_view(x, ShortShapes()) for x in (b"", b"Some words, here"))
    assert len(one[0]) == len(one[1]) and len(two[0]) > 5
    assert np.isclose((two[1] ** 2).sum(), 1, atol=1e-5)
    assert len(meta_view(None, None, None)[0]) > 0


def test_logistic_regression_and_calibration():
    rng = np.random.default_rng(1)
    views, label = [], []
    for _ in range(400):
        y = rng.integers(2)
        views.append((np.array([y if rng.random() < 0.9 else 1 - y, 2]), np.ones(2)))
        label.append(y)
    label = np.array(label)
    rows = Rows(views, 2)
    weights = fit(rows, label, np.ones(400))
    margin = rows.times(weights) + weights[-1]
    assert ((margin > 0) == label).mean() > 0.85
    scale = calibrate(5 * margin, label)
    p = logistic(scale.slope * 5 * margin + scale.shift)
    assert abs(p[margin > 0].mean() - label[margin > 0].mean()) < 0.03


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    labels = spark.read.parquet(f"{MORE}/labels.parquet")
    taught = labels.where("doc_id % 2 = 0")
    found = score(docs, train(docs, taught)).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = found.select("quality", "kept").collect()
    right = np.mean([r.kept == (r.quality == 1) for r in rows])
    good = np.mean([r.kept for r in rows if r.quality == 1])
    assert len(rows) > 1500 and right > 0.99 and good > 0.99


def test_each_view_learns_from_the_other(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for k in range(1200):
        good = rng.random() < 0.5
        text = words(k, 40) if good else words(k, 40).upper()
        docs.append((k, text, "en", f"src{k % 3 if good else 3 + k % 3}", 100 + k))
        if k < 120:
            labels.append((k, int(good)))
    frame = spark.createDataFrame(
        docs, "doc_id long, text string, lang string, source string, n_chars long"
    )
    model = train(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = rows_of(score(frame, model).where("doc_id >= 120"))
    for view in ("p_text", "p_meta", "score"):
        right = np.mean([(r[view] > 0.5) == r["text"].islower() for r in rows])
        assert right > 0.97, view


def test_odd_rows_and_missing_labels(spark):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = odd(spark)
    found = good_documents(docs, no_labels)
    assert found.columns == docs.columns and found.count() == len(odd_rows())
    unscored = score(docs, None)
    assert unscored.where("kept AND score IS NULL").count() == len(odd_rows())
    labels = spark.createDataFrame(
        [(k, k % 2) for k in range(16)] + [(0, 1), (None, 1), (3, None), (5, 7)],
        "doc_id long, quality int",
    )
    taught = spark.read.parquet(f"{DATA}/documents.parquet")
    model = train(taught, spark.read.parquet(f"{DATA}/labels.parquet"))
    scored = rows_of(score(docs, model))
    assert len(scored) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 and isinstance(r["kept"], bool) for r in scored)
    assert train(docs, labels) is None
    assert good_documents(none(spark), labels).count() == 0
    assert score(none(spark), model).count() == 0


@pytest.fixture(scope="module")
def licence_model(spark):
    return fit_licences(spark.read.parquet(f"{DATA}/documents.parquet"))


def test_planted_licences(spark, licence_model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    signs = {
        "apache": "Apache License", "cc-by-nc": "CC BY-NC", "gpl": "GNU General",
        "mit": "MIT License", "proprietary": "All rights reserved",
    }
    found = {r["doc_id"]: r["families"] for r in rows_of(licences(docs, licence_model))}
    for r in docs.collect():
        wanted = [f for f, s in signs.items() if s.lower() in r.text.lower()]
        assert found[r.doc_id] == wanted, r.doc_id


def test_every_family_in_other_words(licence_model):
    for family in FAMILIES:
        for notice in TEMPLATES[family]:
            text = f"{words(1, 90)}\nCopyright 2024. {notice} Thanks.\n{words(2, 300)}"
            (hit,) = scan(text.encode(), licence_model)
            assert hit["family"] == family
            passage = text.encode()[hit["start"] : hit["end"]].decode()
            assert notice[:20] in passage
    inside = f"{words(3, 200)} Released under the MIT License. {words(4, 200)}"
    assert [h["family"] for h in scan(inside.encode(), licence_model)] == ["mit"]


def test_unknown_texts(licence_model):
    for text in (
        "", "of the", "You need a driving license to rent this car in the city.",
        "Licensed under the Acme Terms version 9.",
        "This is a text about the history of software and of its licenses.",
    ):
        assert scan(text.encode(), licence_model) == []
    assert similarity(words_of(b"the MIT license"), "mit") == 1


def test_licences_of_odd_rows(spark, licence_model):
    found = rows_of(licences(odd(spark), licence_model))
    assert len(found) == len(odd_rows())
    assert all(r["families"] == [] for r in found)
    assert licences(none(spark), fit_licences(none(spark))).count() == 0


def test_two_notices_on_one_line(licence_model):
    for text, families in (
        ("Licensed under either of Apache License, Version 2.0 or the MIT License", "apache mit"),
        ("Code is released under the MIT License, text is licensed under CC BY 4.0", "mit cc-by"),
        ("Licensed under the MIT License or the Mozilla Public License 2.0 at your option.", "mit mpl"),
        ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ):
        for line in (text, f"{words(5, 200)} {text} {words(6, 200)}"):
            found = {h["family"] for h in scan(line.encode(), licence_model)}
            assert found == set(families.split()), line
