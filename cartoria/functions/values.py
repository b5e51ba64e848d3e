"""Missing-value semantics. The three kinds of fallback differ in what counts as missing; each has its own helper."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Fixed value: what may be read as a number; suffixes such as 12.5d and 1f, which a cast accepts, are none.
NUMBER = r"^\s*[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\s*$"


def first_truthy(*columns: Column, default: Column | None = None) -> Column:
    """The first value that is neither null nor '' (V1); ``default`` or '' if there is none. Numbers: give 0 as null first."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], default if default is not None else F.lit(""))


def nonzero(number: Column) -> Column:
    """A number, or null where it is null or exactly 0."""
    return F.when(number != 0, number)


def by_key(fields: Column, *keys: str, default: Column | None = None) -> Column:
    """The value of the first key present in a map (V2): an explicit null under a present key stays null."""
    out = default if default is not None else F.lit(None).cast("string")
    for key in reversed(keys):
        out = F.when(F.map_contains_key(fields, F.lit(key)), F.try_element_at(fields, F.lit(key))).otherwise(out)
    return out


def overlay(newer: Column, older: Column) -> Column:
    """``newer`` unless it is null (V3): 0 and '' count as values."""
    return F.coalesce(newer, older)


def number(text: Column) -> Column:
    """Text as a double; null where it isn't a plain decimal number. NaN and infinity in words are read as null."""
    return F.when(text.cast("string").rlike(NUMBER), text.cast("string").try_cast("double"))


def rounded(x: Column, digits: int = 6) -> Column:
    """Rounding in the JVM, half up on the decimal text. Join keys use it on both sides."""
    return F.round(x, digits)


@F.pandas_udf(T.DoubleType())
def rounded_exact(x: pd.Series) -> pd.Series:
    """Rounding to 6 digits, half to even on the exact binary value; one Arrow batch at a time.

    Scaling by a power of ten errs by less than one unit in the last place, so it decides all values but those that come within a few units of a half; only
    these few are rounded one by one.
    """
    v = x.to_numpy(dtype=float, na_value=np.nan)
    scaled = v * 1e6
    out = np.rint(scaled) / 1e6
    close = np.abs(np.abs(scaled - np.trunc(scaled)) - 0.5) <= np.abs(scaled) * 1e-15 + 1e-9
    far = np.abs(scaled) >= 2.0**52
    for i in np.flatnonzero((close | far) & np.isfinite(v)):
        out[i] = round(float(v[i]), 6)
    return pd.Series(out).where(~np.isnan(out), None)
