"""The radial kernel for linear classifiers: random Fourier features.

exp(-gamma |x - y|^2) is the mean of cos(w (x - y)) over normal frequencies w, so the dot product of the sines and cosines of `n`
drawn frequencies estimates it without bias, and by Hoeffding's inequality misses it by `error` or more with a chance of at most
2 exp(-n error^2 / 2), for each pair of rows. A linear classifier over these features costs a scan a step,
where a kernel matrix would grow with the square of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequencies_for(error: float, risk: float) -> int:
    """How many frequencies keep the error of a pair of rows below `error`, but for a chance of `risk`."""
    if not (0 < error <= 2 and 0 < risk < 1):
        raise ValueError("error must be in (0, 2] and risk in (0, 1)")
    return math.ceil(2 / error**2 * math.log(2 / risk))


def scale_gamma(rows: DataFrame, features: Sequence[str]) -> float:
    """1 / (features * variance of all their values), 1 if they do not vary or there are none; one scan."""
    one = rows.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(features)],
                   *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                   *[F.var_pop(c).alias(f"v_{i}") for i, c in enumerate(features)]).first()
    n, mean, spread = (np.array([one[f"{k}_{i}"] or 0.0 for i in range(len(features))], float) for k in "nmv")
    if not n.sum():
        return 1.0
    centre = (n * mean).sum() / n.sum()
    variance = (n * (spread + (mean - centre) ** 2)).sum() / n.sum()
    return float(1 / (len(features) * variance)) if variance > 0 else 1.0


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """A vector column to the cosines and sines of `frequencies` random projections; equal parameters give equal features."""

    gamma: Param[float] = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    frequencies: Param[int] = Param(Params._dummy(), "frequencies", "projections drawn", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol: str = "features", outputCol: str = "fourier", gamma: float = 1.0, frequencies: int = 500, seed: int = 42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="features", outputCol="fourier", gamma=1.0, frequencies=500, seed=42)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, n, seed = (self.getOrDefault(p) for p in (self.gamma, self.frequencies, self.seed))

        @F.pandas_udf("array<double>")
        def project(column: pd.Series) -> pd.Series:
            if column.empty:
                return pd.Series([], dtype=object)
            x = np.stack(column.to_numpy())
            w = np.random.default_rng(seed).normal(scale=math.sqrt(2 * gamma), size=(x.shape[1], n))
            z = x @ w
            return pd.Series(list(np.hstack([np.cos(z), np.sin(z)]) / math.sqrt(n)))

        features = project(vector_to_array(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(features))
