"""Similarity of names by matching blocks: the one function that needs Python."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matched characters over all characters, in capitals; 0 if one is blank."""
    return pd.Series([SequenceMatcher(None, x.upper(), y.upper()).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])
