"""Learned operators on the folds that they did not learn from, against fixed floors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwave.llm.common import table
from panelwave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.1"


def held_out(spark, name, label):
    rows = QUERIES[name](spark, SF_DIR).where("held_out")
    source = table(spark, SF_DIR, "documents" if label == "lang" else "labels")
    return rows.join(source.select("doc_id", label).where(F.col(label).isNotNull()), "doc_id").collect()


def area_under_curve(score, label):
    ranks = np.empty(len(score))
    order = np.argsort(score, kind="stable")
    values, at, n = np.unique(score[order], return_inverse=True, return_counts=True)
    ranks[order] = (np.cumsum(n) - (n - 1) / 2)[at]
    pos = label == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_language(spark):
    rows = held_out(spark, "op2_language_id", "lang")
    right = np.mean([r.lang_pred == r.lang for r in rows])
    assert len(rows) > 1000 and right >= 0.93, right


def test_quality(spark):
    rows = held_out(spark, "op3_quality", "quality")
    auc = area_under_curve(np.array([r.score for r in rows]), np.array([r.quality for r in rows]))
    assert len(rows) > 500 and auc >= 0.95, auc


def test_toxicity(spark):
    rows = held_out(spark, "op8_toxicity", "toxic")
    said, true = np.array([r["p_toxic"] >= 0.5 for r in rows]), np.array([r[-1] == 1 for r in rows])
    recall, precision = said[true].mean(), true[said].mean()
    assert true.sum() > 50 and recall >= 0.8 and precision >= 0.85, (recall, precision)
    severity = np.array([r["severity"] for r in rows])
    assert severity[true].mean() > 1 > 0.2 > severity[~true].mean()


def test_area_under_curve():
    assert area_under_curve(np.array([0.1, 0.4, 0.4, 0.8]), np.array([0, 0, 1, 1])) == pytest.approx(0.875)
