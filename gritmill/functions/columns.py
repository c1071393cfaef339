"""Small column expressions; everything here stays inside Spark's own expression engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by its literal name, so that dots and parentheses in names are safe."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_fractional(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DoubleType, T.FloatType))


def missing(name: str, data_type: T.DataType) -> Column:
    """True for SQL null and, on floating columns, for NaN."""
    test = col(name).isNull()
    return test | F.isnan(col(name)) if is_fractional(data_type) else test


def known(name: str, data_type: T.DataType) -> Column:
    """The value with NaN turned into null."""
    return F.nanvl(col(name), F.lit(None).cast(data_type)) if is_fractional(data_type) else col(name)


def known_double(df: DataFrame, name: str) -> Column:
    return known(name, df.schema[name].dataType).cast("double")


def band(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose upper bound is not exceeded."""
    chain = reduce(
        lambda acc, step: acc.when(value <= F.lit(step[0]), F.lit(step[1])),
        steps[1:],
        F.when(value <= F.lit(steps[0][0]), F.lit(steps[0][1])),
    )
    return chain.otherwise(F.lit(otherwise))


def recode(value: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Replace every listed spelling by the name of its group; keep other values."""
    branches = [(value.isin(list(spellings)), F.lit(name)) for name, spellings in groups.items()]
    if not branches:
        return value
    first, *rest = branches
    chain = reduce(lambda acc, branch: acc.when(*branch), rest, F.when(*first))
    return chain.otherwise(value)


def share(part: Column, whole: Column, digits: int, scale: float = 1.0) -> Column:
    """part / whole * scale, rounded; null when the whole is zero."""
    return F.round(F.try_divide(part, whole) * F.lit(scale), digits)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are known; null when either one is constant.

    The built-in ``corr`` raises on a constant column under ANSI mode, so the ratio is spelled out.
    """
    both = x.isNotNull() & y.isNotNull()
    left, right = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(left, right), F.stddev_pop(left) * F.stddev_pop(right))


def hash_percent(*keys: Column) -> Column:
    """Number from 0 to 99 that depends on the key only, never on partitioning."""
    return F.pmod(hash_long(*keys, digits=8), F.lit(100))


def hash_long(*keys: Column, digits: int = 13) -> Column:
    """Leading hex digits of the key's MD5 as a non-negative long; 13 digits still fit a double exactly."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")
