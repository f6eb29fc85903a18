"""Column profile of the star model, kept per month and merged.

Each column of the fact is read once, into counts per (month, column, value); a month's
column is then a row with its rows, nulls, extremes and a HyperLogLog sketch.
Months merge without the fact: counts add up, extremes and sketches combine, so
a reloaded month replaces its own rows only. Exact distinct counts come from the
value counts, where each value is one row per task before any shuffle. Dimension
attributes are profiled from the counts of the fact's keys: the dimension is
joined to its keys, never to fact rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.joins import join_dim
from ..schemas import DIM_KEYS
from ..session import written
from .dims import Dims
from .star import ALL, ROLE_PLAYING, SIMPLE

MONTH = ["data_year", "data_month"]
LG_K = 12    # a sketch has 2**LG_K registers


def estimate_bound(lg_k: int = LG_K) -> float:
    """Three standard errors of a sketch's estimate, relative."""
    return 3 * 1.04 / math.sqrt(1 << lg_k)


def _value(c: Column, t: T.DataType) -> Column:
    """A value as a number or as text, so that columns of all types unpivot."""
    number = isinstance(t, T.NumericType)
    return F.struct((c.cast("double") if number else F.lit(None).cast("double")).alias("num"),
                    (F.lit(None).cast("string") if number else c.cast("string")).alias("txt"))


def _long(df: DataFrame, names: dict[str, str], keep: list[str]) -> DataFrame:
    """``(*keep, column_name, num, txt)``, one row per row and column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return (df.select(*keep, *[_value(F.col(c), types[c]).alias(n) for c, n in names.items()])
            .unpivot(keep, list(names.values()), "column_name", "v")
            .select(*keep, "column_name", "v.num", "v.txt"))


def _counted(df: DataFrame, c: str, name: str, by: list[str]) -> DataFrame:
    """The counts of one column: a task groups its values alone, by narrow rows."""
    v = _value(F.col(c), df.schema[c].dataType)
    kind = "num" if isinstance(df.schema[c].dataType, T.NumericType) else "txt"
    kept = df.select(*by, v[kind].alias("v")).groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    none = {"num": F.lit(None).cast("double"), "txt": F.lit(None).cast("string")}
    return kept.select(*by, F.lit(name).alias("column_name"),
                       *[(F.col("v") if k == kind else none[k]).alias(k) for k in none], "n")


def value_counts(fact: DataFrame, dims: Dims | None = None, include=ALL, table: str = "fact") -> DataFrame:
    """``(data_year, data_month, column_name, num, txt, n)``: how often each value
    of each column occurs in a file month. Columns are named ``table.column``;
    with ``dims``, those of the dimensions in ``include`` follow, as a star view
    by pickup role has them (null where a key has no row). ``fact`` is a stored
    table: every column is read when this is called, each once and in tasks of its
    own, which so hold the values of one column only; the counts are written to the
    shared folder."""
    months = fact.withColumns({f"__{c}": F.col(c) for c in MONTH})
    by = [f"__{c}" for c in MONTH]
    each = [_counted(months, c, f"{table}|{c}", by) for c in fact.columns]
    counts = written(reduce(DataFrame.unionByName, each), "profile", table)
    frames = [counts]
    for name in include if dims is not None else ():
        dim = dims.table(name)
        if dim is None:
            continue
        key, fk = (ROLE_PLAYING[name][:2] if name in ROLE_PLAYING else SIMPLE[name][:2])
        keyed = dim.select(F.col(DIM_KEYS[f"dim_{name}"]).cast("double").alias("__k"), *dim.columns)
        keys = counts.where(F.col("column_name") == f"{table}|{fk}").select(*by, "num", "n")
        joined = join_dim(keys, keyed, keys["num"] == keyed["__k"], "left", name in dims.small)
        frames.append(_long(joined, {c: f"dim_{name}|{c}" for c in dim.columns}, [*by, "n"])
                      .groupBy(*by, "column_name", "num", "txt").agg(F.sum("n").alias("n")))
    every = reduce(DataFrame.unionByName, frames)
    return every.select(*[F.col(b).alias(c) for b, c in zip(by, MONTH)],
                        F.translate("column_name", "|", ".").alias("column_name"), "num", "txt", "n")


def _null() -> Column:
    return F.col("num").isNull() & F.col("txt").isNull()


def month_profile(counts: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One row per month and column from ``value_counts``, mergeable:
    ``n_rows``, ``null_rows``, extremes and ``sketch``."""
    value = F.coalesce("txt", F.col("num").cast("string"))
    return counts.groupBy(*MONTH, "column_name").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(_null(), F.col("n"))), F.lit(0)).alias("null_rows"),
        F.min("num").alias("min_num"), F.max("num").alias("max_num"),
        F.min("txt").alias("min_txt"), F.max("txt").alias("max_txt"),
        F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merge_months(months: DataFrame) -> DataFrame:
    """The profile of all months of ``month_profile``: one row per column, with
    ``estimate``, the distinct values estimated from the merged sketches."""
    return months.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("null_rows").alias("null_rows"),
        F.min("min_num").alias("min_num"), F.max("max_num").alias("max_num"),
        F.min("min_txt").alias("min_txt"), F.max("max_txt").alias("max_txt"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def exact_distinct(counts: DataFrame) -> DataFrame:
    """``(column_name, distinct_values)`` over all months, nulls not counted."""
    return (counts.where(~_null()).groupBy("column_name", "num", "txt").agg(F.lit(1).alias("one"))
            .groupBy("column_name").agg(F.count("one").alias("distinct_values")))
