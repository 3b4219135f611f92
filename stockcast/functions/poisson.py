"""Poisson draws and quantiles. Spark has no Poisson quantile, so a small Arrow UDF supplies it."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

COVERAGE = (0.025, 0.975)
_BOUNDS = T.StructType().add("yhat_lower", T.LongType()).add("yhat_upper", T.LongType())
_DRAW = T.StructType([T.StructField("yhat", T.LongType()), *_BOUNDS.fields])


#: above this mean the quantile comes from the normal law with its first correction, whose error is far below one count
#: per standard deviation there; below it the table of probabilities holds at most 24 * sqrt(LARGE_MEAN) + 40 numbers
LARGE_MEAN = 1e8


def _cumulative(mean: float) -> tuple[int, np.ndarray]:
    """First count with weight and the running probabilities from there on, which end at 1.

    Twelve standard deviations to either side hold all the mass a 32-bit uniform can hit.
    """
    reach = 12.0 * math.sqrt(mean)
    low = max(0, math.floor(mean - reach - 10))
    counts = np.arange(low + 1, math.ceil(mean + reach + 30) + 1, dtype=float)
    start = low * math.log(mean) - mean - math.lgamma(low + 1)
    logs = start + np.concatenate(([0.0], np.cumsum(np.log(mean) - np.log(counts))))
    running = np.cumsum(np.exp(logs))
    return low, running / running[-1]


def quantile(mean: float, probability) -> np.ndarray:
    """Smallest count whose running probability reaches `probability`; 0 for a mean of 0."""
    if not mean > 0:
        return np.zeros(np.shape(probability), dtype=np.int64)
    if mean > LARGE_MEAN:
        inside = np.clip(np.asarray(probability, float), 1e-12, 1 - 1e-12)
        z = np.vectorize(NormalDist().inv_cdf, otypes=[float])(inside)
        return np.maximum(np.ceil(mean + z * math.sqrt(mean) + (z * z - 1) / 6 - 0.5), 0).astype(np.int64)
    low, running = _cumulative(float(mean))
    return low + np.searchsorted(running, probability, side="left")


def _bounds(means: np.ndarray) -> np.ndarray:
    distinct, where = np.unique(means, return_inverse=True)
    table = np.array([quantile(m, COVERAGE) for m in distinct], dtype=np.int64).reshape(-1, 2)
    return table[where]


@F.pandas_udf(_BOUNDS)
def poisson_bounds(mean: pd.Series) -> pd.DataFrame:
    """95 % interval of a Poisson count with the given mean."""
    return pd.DataFrame(_bounds(mean.fillna(0.0).to_numpy(float)), columns=_BOUNDS.names)


@F.pandas_udf(_DRAW)
def poisson_draw(rate: pd.Series, u: pd.Series) -> pd.DataFrame:
    """Count drawn at `rate` with the uniform `u`, and the 95 % interval around the drawn count."""
    distinct, where = np.unique(rate.fillna(0.0).to_numpy(float), return_inverse=True)
    uniforms = u.to_numpy(float)
    drawn = np.zeros(len(uniforms), dtype=np.int64)
    order = np.argsort(where, kind="stable")
    edges = np.searchsorted(where[order], np.arange(len(distinct) + 1))
    for mean, begin, end in zip(distinct, edges[:-1], edges[1:]):
        rows = order[begin:end]
        drawn[rows] = quantile(mean, uniforms[rows])
    bounds = _bounds(drawn.astype(float))
    return pd.DataFrame({"yhat": drawn, "yhat_lower": bounds[:, 0], "yhat_upper": bounds[:, 1]})
