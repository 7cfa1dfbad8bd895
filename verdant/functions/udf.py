"""The two Python helpers Spark has no built-in for, as Arrow UDFs.

Both are element-wise string maps over an Arrow batch; they run inside the
executor that holds the partition.  Callers apply them to distinct values or
short extracted fields, never to whole pages where a built-in would do.
:func:`nfkc` also meets whole texts: it walks a batch in slices, so that what it
holds beside the batch does not depend on the rows of a batch.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


SLICE_BYTES = 1 << 20      # text that is turned into Python strings at a time


def nfkc_slices(s: pa.Array, slice_bytes: int = SLICE_BYTES) -> pa.Array:
    """NFKC of a string array, slice by slice of about ``slice_bytes``."""
    done, at = [], 0
    step = max(1, len(s) * slice_bytes // max(s.nbytes, 1))
    while at < len(s):
        part = s.slice(at, step).to_pylist()
        done.append(pa.array([x if x is None else unicodedata.normalize("NFKC", x) for x in part], s.type))
        at += step
    return pa.concat_arrays(done) if done else s


@F.arrow_udf(StringType())
def nfkc(s: pa.Array) -> pa.Array:
    """Unicode NFKC normal form (nulls stay null)."""
    return nfkc_slices(s)


@F.pandas_udf(StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    """Decode HTML character references, named and numeric (nulls stay null)."""
    return s.map(lambda x: x if x is None or "&" not in x else html.unescape(x))


@F.pandas_udf(ArrayType(StringType()))
def html_unescape_all(s: pd.Series) -> pd.Series:
    """``html_unescape`` over every element of a string list, one call per batch.

    Lets a page's extracted fields be decoded inside the page's own row, so
    extraction needs no shuffle to regroup them.
    """
    def one(arr):
        if arr is None:
            return None
        return [x if x is None or "&" not in x else html.unescape(x) for x in arr]
    return s.map(one)
