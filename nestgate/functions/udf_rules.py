"""User rules on a whole list per row, run as Arrow-batched pandas UDFs.

Only for rules that built-in expressions cannot state.  Each batch is handled
with vectorised Arrow/numpy kernels over the flattened list values (no Python
loop per row, never row-at-a-time Python UDFs).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_min(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Per-row minimum of a batch of double lists, nulls ignored.

    Returns (minimum, defined): ``defined`` is false for null lists and for
    lists without a non-null value.  Batches arrive with nulls as NaN, so a
    NaN value also counts as missing here (Spark's own ordering would rank it
    above every number)."""
    arr = pa.array(values, type=pa.list_(pa.float64()), from_pandas=True)
    flat, parents = pc.list_flatten(arr), pc.list_parent_indices(arr)
    keep = pc.is_valid(flat)
    v = flat.filter(keep).to_numpy(zero_copy_only=False)
    p = parents.filter(keep).to_numpy(zero_copy_only=False)
    mins = np.full(len(arr), np.inf)
    np.minimum.at(mins, p, v)
    defined = np.zeros(len(arr), dtype=bool)
    defined[p] = True
    return mins, defined


def min_greater_than(bound: float):
    """``min(list) > bound`` with nulls ignored; empty or null lists give null (pass)."""

    @F.pandas_udf(T.BooleanType())
    def rule(values: pd.Series) -> pd.Series:
        mins, defined = list_min(values)
        out = pd.Series(mins > bound, dtype="boolean")
        out[~defined] = pd.NA
        return out

    return rule
