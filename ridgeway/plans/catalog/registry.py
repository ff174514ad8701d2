"""Registry of catalogue queries and the shared rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collections.abc import Callable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


_FITS: dict[tuple, object] = {}


def fitted(spark: SparkSession, sf_dir: str, name: str, fit: Callable[[], object]):
    """The fit ``name`` over the tables of ``sf_dir``, run once per application: several queries examine one fit.

    What is kept is parameter-sized (weights and trace; the dual SVM's multipliers are a written table).
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FITS:
        _FITS[key] = fit()
    return _FITS[key]


def forget_fits() -> None:
    """Make the next query run its fit anew (benchmarks)."""
    _FITS.clear()


def round_half_up(c, digits: int = 6):
    """floor(x·10^k + 0.5)/10^k: the same binary operations as the oracle's rounding,
    so both sides agree on ties (Spark's ``round`` rounds the decimal string)."""
    scale = float(10**digits)
    return F.floor(c.cast("double") * scale + 0.5) / scale


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (names unchanged)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_up(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
