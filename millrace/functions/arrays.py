"""Functions over numeric arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def argmax(values: Column) -> Column:
    """Zero-based position of the largest element; the first one wins a tie. All zeros give 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


@F.pandas_udf(T.IntegerType())
def argmax_in_pandas(values: pd.Series) -> pd.Series:
    """The same by Arrow batch, kept to compare the two. Null and empty arrays give null."""
    lengths = values.map(len, na_action="ignore").fillna(0).astype(int)
    found = pd.Series(pd.NA, index=values.index, dtype="Int32")
    for length in lengths[lengths > 0].unique():  # arrays of one length stack to a matrix
        same = lengths.index[lengths == length]
        found[same] = np.stack(values[same].to_list()).argmax(axis=1)
    return found
