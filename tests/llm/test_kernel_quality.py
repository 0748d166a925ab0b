"""Random Fourier quality classifier: statistics, sums, calibration against plain forms; accuracy on rows not learned from."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtally.llm import kernel_quality as kq
from tests.llm.helpers import SCALE, documents

TEXTS = [None, "", " \n\t ", "one", "Ünïcode 漢字 😀 and, more. words!\nA second line | with pipes\n\nA second line | with pipes",
         "the cat sat on the mat the cat sat on the mat", "x" * 20_000, "word " * 3000]
AT = {name: i for i, name in enumerate(kq.STATISTICS)}


def test_statistics_of_each_text_alone():
    found = kq.statistics(TEXTS)
    assert found.shape == (len(TEXTS), len(kq.STATISTICS)) and np.isfinite(found).all()
    for row, text in zip(found, TEXTS):
        assert np.allclose(row, kq.statistics([text])[0])
        words = [word for word in (text or "").encode().split()]
        assert row[AT["log_bytes"]] == pytest.approx(math.log1p(len((text or "").encode())))
        assert row[AT["log_words"]] == pytest.approx(math.log1p(len(words)))
        assert row[AT["word_mean"]] == pytest.approx(np.mean([*map(len, words)]) if words else 0)
        assert row[AT["word_deviation"]] == pytest.approx(np.std([*map(len, words)]) if words else 0, abs=1e-6)
        lower = [word.lower() for word in words]
        assert row[AT["different_words"]] == pytest.approx(1 - (len(words) - len({*lower})) / max(1, len(words)))
        fives = [tuple(lower[i:i + 5]) for i in range(len(lower) - 4)]
        assert row[AT["repeated_fives"]] == pytest.approx((len(fives) - len({*fives})) / max(1, len(words)))
        lines = [line for line in (text or "").split("\n") if line]
        assert row[AT["equal_lines"]] == pytest.approx((len(lines) - len({*lines})) / max(1, len(lines)))
        shares = [n / len(text.encode()) for n in np.bincount(np.frombuffer(text.encode(), np.uint8)) if n] if text else []
        assert row[AT["entropy"]] == pytest.approx(-sum(p * math.log2(p) for p in shares), abs=1e-9)


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, len(kq.STATISTICS)))
    z = kq.Fourier(np.zeros(x.shape[1]), np.ones(x.shape[1])).features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * kq.BANDWIDTH ** 2 * x.shape[1]))
    assert np.abs(z @ z.T - exact).mean() < 0.06


def labelled_frame(spark, n=500, parts=7):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((n, len(kq.STATISTICS)))
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    rows = [(row.tolist(), float(label), i % kq.FOLDS) for i, (row, label) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "statistics array<double>, label double, fold int").repartition(parts)


def test_partition_sums_equal_the_whole(spark):
    x, y, frame = labelled_frame(spark)
    fourier = kq._scaling(frame)
    z = np.column_stack([kq.Fourier(x.mean(axis=0), x.std(axis=0)).features(x), y])
    folds = np.arange(len(x)) % kq.FOLDS
    found = kq.normal_equations(frame, fourier)
    for fold in range(kq.FOLDS):
        assert np.allclose(found[fold], z[folds == fold].T @ z[folds == fold])
    weights = kq._solved(found.sum(axis=0), 1e-3)
    assert kq._square_error(found.sum(axis=0), weights) == pytest.approx(((z[:, :-1] @ weights - y) ** 2).sum())
    model = kq.fit(frame)
    assert ((model.score(x) >= 0.5) == (y > 0.5)).mean() > 0.9


def test_pooled_is_the_best_rising_fit():
    rng = np.random.default_rng(3)
    raw = np.sort(rng.uniform(0, 1, 60))
    labels = (rng.uniform(0, 1, 60) < raw).astype(float)
    knots, values = kq.pooled(np.ones(60), labels, raw)
    assert (np.diff(knots) > 0).all() and (np.diff(values) >= 0).all() and 0 < values.min() and values.max() < 1
    # The plain form: at each place the largest of the least means to its right, over all beginnings.
    mean = lambda i, j: labels[i:j + 1].mean()
    exact = [max(min(mean(i, j) for j in range(k, 60)) for i in range(k + 1)) for k in range(60)]
    sizes = [np.isclose(exact, level).sum() for level in np.unique(np.round(exact, 12))]
    assert len(sizes) == len(knots)


def test_accuracy_on_held_out_rows(spark):
    rows = {row.doc_id: row for row in kq.quality_classifier(spark, str(SCALE)).collect()}
    labels = [row for row in spark.read.parquet(str(SCALE / "labels.parquet")).collect()]
    docs = spark.read.parquet(str(SCALE / "documents.parquet"))
    assert len(rows) == docs.count()
    assert all(row.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and row.predicted == (row.score >= 0.5) for i, row in rows.items())
    unseen = [(rows[row.doc_id].predicted, row.quality) for row in labels if rows[row.doc_id].held_out]
    assert np.mean([a == b for a, b in unseen]) > 0.97


def test_awkward_rows(spark):
    docs = documents(spark, [*TEXTS, *TEXTS], extra=True).unionByName(documents(spark, ["text"], extra=True).withColumn("doc_id", F.lit(None).cast("bigint")))
    measured = kq.with_statistics(docs)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    for labels, expected in ((none, 0.5), (spark.createDataFrame([(0, None), (None, 1)], none.schema), 0.5)):
        scored = kq.score(measured, kq.fit(kq.with_labels(measured, labels))).collect()
        assert {row.score for row in scored} == {expected} and len(scored) == docs.count()
    one = spark.createDataFrame([(i, 1) for i in range(20)] * 2, none.schema)
    assert min(row.score for row in kq.score(measured, kq.fit(kq.with_labels(measured, one))).collect()) > 0.8
    empty = kq.with_statistics(documents(spark, []))
    assert kq.score(empty, kq.fit(kq.with_labels(empty, one))).collect() == []
