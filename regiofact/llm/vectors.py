"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector can have a cosine: not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(finite, F.lit(False)) & F.coalesce(nonzero, F.lit(False))


def units(vectors) -> np.ndarray:
    """Rows of equal length scaled to norm one, in double precision and without overflow."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
