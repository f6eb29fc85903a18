"""Monthly trip feed sources.

Monthly files of one feed do not share one physical schema: a column may be
INT64 in one month and DOUBLE in another, or change case (``airport_fee`` /
``Airport_fee``). Parquet cannot read INT64 as DOUBLE under a declared
schema, so by default each month is read with its own footer schema and
conformed by name to the declared raw schema (``try_cast`` only where the
physical type differs, missing columns as null); months with one schema are
one scan, and there is one union branch per distinct schema. ``infer=False`` reads every month with the declared schema in a
single scan when the files are known to agree.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..period import Period
from ..schemas import RAW

# Landing layout: one file (or one folder of part files) per feed and month.
PATH_TEMPLATE = "{root}/{year}/{month}/{feed}_tripdata_{year}-{month}"
FEED_FILE_PREFIX = {"yellow": "yellow", "green": "green", "highvol": "fhvhv"}


def feed_path(root: str, feed: str, period: Period, template: str = PATH_TEMPLATE) -> str:
    return template.format(root=root.rstrip("/"), year=period.year, month=period.month,
                           feed=FEED_FILE_PREFIX[feed])


def conform_raw(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by case-insensitive name: same type as is,
    another type through ``try_cast``, a missing column as typed null."""
    have = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif src.dataType == f.dataType:
            cols.append(F.col(src.name).alias(f.name))
        else:
            cols.append(F.col(src.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_feed(spark: SparkSession, feed: str, periods: Period | Iterable[Period], root: str,
              template: str = PATH_TEMPLATE, infer: bool = True,
              tag: bool = False) -> DataFrame:
    """Raw rows of ``feed`` for one or many months, in the declared raw
    schema. ``tag`` adds the file period as ``data_year`` / ``data_month``."""
    periods = [periods] if isinstance(periods, Period) else list(periods)

    def reader():   # a fresh reader per read: .schema() changes a reader in place
        return spark.read.option("recursiveFileLookup", True)

    if not infer and not tag:   # one scan over every month's files
        return reader().schema(RAW[feed]).parquet(
            *[feed_path(root, feed, p, template) for p in periods])
    frames = []
    if infer and template == PATH_TEMPLATE and len(periods) > 1:
        # One scan per distinct footer schema; the file's path names its month.
        groups: dict[str, list[str]] = {}
        for p in periods:
            path = feed_path(root, feed, p)
            groups.setdefault(reader().parquet(path).schema.json(), []).append(path)
        month = rf".*/(\d{{4}})/(\d{{2}})/{FEED_FILE_PREFIX[feed]}_tripdata_"
        at = lambda i: F.regexp_extract("_metadata.file_path", month, i)
        for schema, paths in groups.items():
            df = reader().schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths)
            df = df.withColumns({"__year": at(1), "__month": at(2)}) if tag else df
            tags = [T.StructField(c, T.StringType()) for c in ("__year", "__month")] if tag else []
            frames.append(conform_raw(df, T.StructType([*RAW[feed].fields, *tags]))
                          .withColumnsRenamed({"__year": "data_year", "__month": "data_month"}))
        return reduce(DataFrame.unionByName, frames)
    for p in periods:
        path = feed_path(root, feed, p, template)
        df = (conform_raw(reader().parquet(path), RAW[feed]) if infer
              else reader().schema(RAW[feed]).parquet(path))
        if tag:
            df = df.withColumns({"data_year": F.lit(p.year), "data_month": F.lit(p.month)})
        frames.append(df)
    return reduce(DataFrame.unionByName, frames)
