"""The toxicity fit learns from every labelled row, in one part or in many."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelwave.llm import ordinal_toxicity
from panelwave.llm.common import labelled_sample


def tables(spark, n: int, rare=frozenset()):
    """``n`` clean and ``n`` toxic rows; toxic rows whose id is in ``rare`` hold another word than the others."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(400)]
    docs = []
    for i in range(2 * n):
        body = rng.choices(vocabulary, k=12)
        if i < n:
            body += ["zorgle" if i in rare else "blarnak"] * rng.randint(1, 3)
        docs.append((i, " ".join(body)))
    labels = [(i, int(i < n)) for i in range(2 * n)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_a_word_outside_the_first_rows_is_learned(spark):
    n = 3060
    labels = tables(spark, n)[1]
    first = {r["id"] for r in labelled_sample(labels, "toxic", "doc_id", F.lit(True), 3000).where("label = 1").collect()}
    docs, labels = tables(spark, n, frozenset(range(n)) - first)
    model = ordinal_toxicity.learn(docs, labels, F.lit(True))
    above = model.above(np.array([model.margin(t) for t in ("some zorgle here", "some blarnak here", "some words here")]))
    assert (above[:, 0] >= 0.5).tolist() == [True, True, False]


def test_parts_give_the_model_of_one_part(spark):
    docs, labels = tables(spark, 150, frozenset(range(0, 150, 3)))
    # A repeated row, one without a text, an id without a document, a NULL id, a NULL label and a label of no meaning.
    docs = docs.union(docs.where("doc_id = 7")).union(spark.createDataFrame([(900, None), (None, "zorgle")], docs.schema))
    odd = [(900, 0), (901, 1), (None, 1), (3, None), (5, 7)]
    labels = labels.union(spark.createDataFrame(odd, labels.schema))
    one = ordinal_toxicity.learn(docs, labels, F.lit(True))
    many = ordinal_toxicity.learn(docs, labels, F.lit(True), part_bytes=6000)
    assert one.features.tolist() == many.features.tolist()
    assert many.weights == pytest.approx(one.weights, abs=1e-6)
    assert many.thresholds == pytest.approx(one.thresholds, abs=1e-6)


def test_every_telling_feature_is_learned(spark):
    """Each of the 1,500 words that tell of toxic rows has four features."""
    rng = random.Random(8)
    vile = ["".join(rng.choices("abcdefghijklm", k=8)) for _ in range(1500)]
    plain = ["".join(rng.choices("nopqrstuvwxyz", k=8)) for _ in range(40)]
    rows = [" ".join(vile) if i % 2 else " ".join(rng.choices(plain, k=30)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = ordinal_toxicity.learn(docs, labels, F.lit(True))
    telling = {f for word in vile for f in ordinal_toxicity.features_of(word)}
    # A few share their number with a feature of the plain words.
    assert len(telling) > 5500 and len(telling - set(model.features.tolist())) < 10


def test_the_pipeline_learns_from_all_labels(spark, tmp_path):
    """Toxic rows whose ids lie in the fold that ``op8_toxicity`` holds out."""
    fold = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 0][:40]
    toxic = set(fold)
    rows = [(i, "zorgle blarnak vexitor " * 3 if i in toxic else f"some plain words here {i % 7}") for i in range(400)]
    rows += [(i, "zorgle blarnak vexitor " * 3) for i in fold if i >= 400]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i, _ in rows], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _ in rows if i not in toxic]
