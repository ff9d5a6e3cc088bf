"""Random Fourier features approximate the radial kernel within their bound."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from assayer.operators import models
from assayer.operators.kernels import FourierFeatures, frequencies_for, scale_gamma
from assayer.spec import ModelSpec, TableSpec

SPEC = TableSpec(types={}, numeric=("a", "b"), categorical=(), target="label", key="k")


def rings(spark, n=400):
    random = np.random.default_rng(1)
    label = random.integers(0, 2, n)
    radius, angle = 1 + 2 * label + random.normal(scale=0.15, size=n), random.uniform(0, 2 * np.pi, n)
    rows = [(i, float(r * np.cos(t)), float(r * np.sin(t)), int(y)) for i, (r, t, y) in enumerate(zip(radius, angle, label))]
    return spark.createDataFrame(rows, "k bigint, a double, b double, label int").repartition(4)


def test_the_kernel_is_met_within_the_bound(spark):
    gamma, error, risk = 0.7, 0.1, 0.01
    rows = rings(spark, 120)
    stage = FourierFeatures(inputCol="v", outputCol="z", gamma=gamma, frequencies=frequencies_for(error, risk), seed=3)
    out = stage.transform(rows.withColumn("v", array_to_vector(F.array("a", "b")))).select("a", "b", vector_to_array("z").alias("z")).collect()
    x, z = np.array([[r.a, r.b] for r in out]), np.array([r.z for r in out])
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    missed = np.abs(z @ z.T - kernel) >= error
    assert missed.mean() <= risk and np.allclose((z**2).sum(1), 1)


def test_the_bound_says_how_many_frequencies(spark):
    assert frequencies_for(0.1, 0.01) == 1060 and frequencies_for(0.15, 0.01) == 471
    with pytest.raises(ValueError):
        frequencies_for(0, 0.1)


def test_gamma_is_scaled_by_the_variance_of_all_values(spark):
    rows = rings(spark)
    values = np.array([[r.a, r.b] for r in rows.collect()])
    assert scale_gamma(rows, ["a", "b"]) == pytest.approx(1 / (2 * values.var()))
    assert scale_gamma(rows.where(F.lit(False)), ["a", "b"]) == 1.0
    assert scale_gamma(rows.withColumn("a", F.lit(2.0)), ["a"]) == 1.0


def test_rings_are_separated_and_the_model_is_kept(spark, tmp_path):
    rows = rings(spark)
    right = {}
    for kernel in ("linear", "rbf"):
        fitted = models.fit(rows, SPEC, ModelSpec("SVC", {"C": 1.0, "kernel": kernel}))
        right[kernel] = models.score(fitted, rows, "SVC", "k").where("prediction = label").count() / rows.count()
    assert right["linear"] < 0.75 and right["rbf"] > 0.98
    path = models.save_model(fitted, str(tmp_path), "r1", "SVC")
    again = models.score(PipelineModel.load(path), rows, "SVC", "k")
    both = again.join(models.score(fitted, rows, "SVC", "k").select("k", F.col("score").alias("s")), "k")
    assert both.where("abs(score - s) < 1e-9").count() == rows.count()
    with pytest.raises(ValueError, match="no kernel"):
        models.build_classifier(ModelSpec("SVC", {"kernel": "cubic"}), 1)
