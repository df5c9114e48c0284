"""Name forms and likeness that built-in functions cannot give: full Unicode folding and the sequence ratio.

They are Arrow functions over columns. Feeds repeat their names, so `with_likeness` compares each distinct pair once; the built-in forms
in `exprs` stay for cheap filters, and equal these on plain ASCII.
"""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from matchlake.functions.exprs import SPECIAL


def folded(text: str | None) -> str | None:
    """Compatibility decomposition, no combining marks, case folded, & as and, anything else as single spaces."""
    if text is None:
        return None
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    for a, b in SPECIAL.items():
        text = text.replace(a, b)
    return re.sub("[^a-z0-9]+", " ", text.replace("&", " and ")).strip()


def ratio(a: str | None, b: str | None) -> float:
    """Twice the matching characters over all, matches found longest first (Ratcliff and Obershelp); 0 for nulls and blanks."""
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def likeness(a: str | None, b: str | None, least: int = 4, contained: float = 0.94) -> float:
    """1 for equal names, at least `contained` if one of `least` letters lies in the other, else the sequence ratio; 0 for nulls and blanks."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    short, long_ = sorted((len(a), len(b)))
    return max(contained, short / long_) if short >= least and (a in b or b in a) else ratio(a, b)


@F.pandas_udf(StringType())
def fold_exact(c: pd.Series) -> pd.Series:
    return c.map(folded)


@F.pandas_udf(StringType())
def cjk_exact(c: pd.Series) -> pd.Series:
    """Full compatibility composition, without separators and brackets."""
    return c.map(lambda t: None if t is None else re.sub(r"[\s　·・.,()\[\]（）【】-]", "", unicodedata.normalize("NFKC", t)))


@F.pandas_udf(DoubleType())
def sequence_sim(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([likeness(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def plain_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The sequence ratio alone."""
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """df with the likeness of two columns, found once for each distinct pair of values; null-safe."""
    pairs = df.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct().withColumn(name, sequence_sim("_a", "_b"))
    return df.join(pairs, df[a].eqNullSafe(pairs["_a"]) & df[b].eqNullSafe(pairs["_b"])).drop("_a", "_b")


def exact_forms(c: Column) -> Column:
    """exact_name with full folding."""
    return F.regexp_replace(fold_exact(c), " ", "")
