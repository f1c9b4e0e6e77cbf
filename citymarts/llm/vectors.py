"""Vector columns: validity, and moving them between Arrow and numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import row_key


def clean(col: str) -> Column:
    """``col`` as array<double> without negative zeros; NULL unless it has
    components, all finite and not all zero."""
    e = F.transform(F.col(col), lambda x: x.cast("double") + F.lit(0.0))
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when((F.size(F.col(col)) > 0) & finite & F.exists(e, lambda x: x != 0), e)


def keyed(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``_rid`` (unique, in id order), ``_id`` and ``_v`` (clean vector or NULL)."""
    rows = df.select(F.col(id_col).cast("long").alias("_id"), clean(vector_col).alias("_v"))
    return row_key(rows, "_id", "_v")


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def lists(x: np.ndarray) -> pa.Array:
    """A list column of the rows of ``x``."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(x).reshape(-1)))


def by_length(col: pa.Array):
    """``(rows, matrix)`` for each length of list that occurs."""
    n = np.diff(col.offsets.to_numpy())
    for d in np.unique(n):
        rows = np.flatnonzero(n == d)
        yield rows, matrix(col.take(pa.array(rows)))
