"""Import of dimensions from CSV that keeps the lines it cannot load.

A line is split by position in the order of the warehouse's bulk load and typed
column by column. A line that cannot be a row goes to the rejects with the text
of the line and the reason: the wrong number of columns or broken quotes, a
value that is not of the column's type, text wider than the column (widths
count bytes, as the warehouse's do), or an empty key. The rest of the file loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DIM_KEYS, DIMS

# The warehouse's varchar widths, in bytes.
WIDTHS = {
    "dim_base": {"license_no": 10, "entity_name": 50, "type_of_base": 50},
    "dim_flags": {"shared_request_flag": 1, "shared_match_flag": 1, "wav_request_flag": 1, "wav_match_flag": 1},
    "dim_license": {"license_number": 10, "license_holder": 10},
    "dim_triptype": {"trip_type": 20},
    "dim_payment": {"payment_type": 20},
    "dim_zone": {"borough": 20, "zone": 50, "service_zone": 20},
    "dim_ratecode": {"ratecode": 20},
    "dim_vendor": {"vendor": 50},
}
# Column order of the bulk load where it is not that of the table.
POSITIONS = {
    "dim_date": ["full_date", "year", "quarter", "month", "day", "day_of_week", "week_number", "is_weekday",
                 "is_weekend", "dateid"],
    "dim_time": ["hour", "minute", "time_id"],
}


def positions(name: str) -> list[str]:
    return POSITIONS.get(name, [f.name for f in DIMS[name].fields])


def import_dim(spark: SparkSession, name: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``name``, rejects ``(table_name, line, reason)``) of a headered CSV
    file or folder. An empty field is null; quotes inside quotes are doubled."""
    types = {f.name: f.dataType for f in DIMS[name].fields}
    order = positions(name)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in order]).add("_line", "string")
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path))
    typed, bad = {}, []
    for c in order:
        src = F.col(c)
        if isinstance(types[c], T.StringType):
            typed[c] = src
            wide = WIDTHS.get(name, {}).get(c)
            if wide:
                bad.append(F.when(F.octet_length(src) > wide, f"{c} wider than {wide}"))
        else:
            typed[c] = src.try_cast(types[c])
            bad.append(F.when(src.isNotNull() & typed[c].isNull(), f"{c} not {types[c].simpleString()}"))
    bad.append(F.when(F.col(DIM_KEYS[name]).isNull(), f"{DIM_KEYS[name]} empty"))
    reason = F.when(F.col("_line").isNotNull(), "malformed line").otherwise(F.concat_ws("; ", *bad))
    # A well-formed line is put together again for the rejects.
    again = F.coalesce("_line", F.to_csv(F.struct(*order), {"escape": '"', "emptyValue": ""}))
    every = raw.select(*[F.col(c).alias(f"__{c}") for c in order], *[v.alias(c) for c, v in typed.items()],
                       again.alias("line"), reason.alias("reason"))
    good = every.where(F.col("reason") == "").select(*[f.name for f in DIMS[name].fields])
    rejects = every.where(F.col("reason") != "").select(F.lit(name).alias("table_name"), "line", "reason")
    return good, rejects


def export_dim(df: DataFrame, name: str, path: str) -> None:
    """Write a dimension as headered CSV in the order that ``import_dim`` reads."""
    df.select(*positions(name)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
