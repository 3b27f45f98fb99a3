"""Projections, filters, missing values, encodings and derived columns."""
from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from lumenframe.functions.joins import counted_join
from lumenframe.functions.ordering import ranked


def keep_columns(df: DataFrame, names: list[str] | None = None, kind: str | None = None) -> DataFrame:
    """Columns by name, or all of kind 'numeric' or 'text'."""
    if names is None:
        wanted = {"numeric": NumericType, "text": StringType}[kind]
        names = [f.name for f in df.schema if isinstance(f.dataType, wanted)]
    return df.select(*names)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def add_label(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column."""
    return df.withColumn(name, F.lit(value))


def filter_rows(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def drop_missing(df: DataFrame, subset: list[str] | None = None, how: str = "any") -> DataFrame:
    return df.dropna(how=how, subset=subset)


def fill_missing(df: DataFrame, numeric: float = 0.0, text: str = "None") -> DataFrame:
    """Nulls in numeric and in text columns."""
    return df.fillna(numeric).fillna(text)


def fill_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls become the most frequent value; the smallest one on ties."""
    fills = {}
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        fills[c] = F.coalesce(c, counts.orderBy(F.desc("_n"), F.asc(c)).limit(1).select(c).scalar())
    return df.withColumns(fills)


def map_values(df: DataFrame, col: str, mapping: dict, default=None, out: str | None = None) -> DataFrame:
    """Values by a fixed mapping; others become the default."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(lookup, F.col(col))
    return df.withColumn(out or col, F.coalesce(found, F.lit(default)) if default is not None else found)


def encode_first_seen(df: DataFrame, col: str, order: str, start: int = 0) -> DataFrame:
    """Code of each value by its first appearance in `order`."""
    first = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    codes = ranked(first, ["_first", col], "code").select(col, "_n", (F.col("code") + (start - 1)).alias("code"))
    return counted_join(df, codes, col, n="_n")


def encode_sorted(df: DataFrame, col: str, start: int = 0) -> DataFrame:
    """Code of each value by its place in sorted order."""
    values = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    codes = ranked(values, [col], "code").select(col, "_n", (F.col("code") + (start - 1)).alias("code"))
    return counted_join(df, codes, col, n="_n")


def coerce_numeric(df: DataFrame, cols: list[str], drop: bool = True) -> DataFrame:
    """Text to double; what is no number becomes null and its row is dropped."""
    out = df.withColumns({c: F.col(c).try_cast("double") for c in cols})
    return out.dropna(subset=cols) if drop else out


def parse_currency(df: DataFrame, cols: list[str], type_: str = "double") -> DataFrame:
    """'$60,000.00' to a number."""
    return df.withColumns({c: F.regexp_replace(c, r"[$,\s]", "").try_cast(type_) for c in cols})


def date_to_year(df: DataFrame, col: str, out: str = "year") -> DataFrame:
    """Year of 'd-MMM-yy' text; two digits from 69 on belong to the 1900s."""
    parsed = F.year(F.try_to_timestamp(F.col(col), F.lit("d-MMM-yy")))
    short = F.pmod(parsed, F.lit(100))
    return df.withColumn(out, F.when(short >= 69, 1900 + short).otherwise(2000 + short))


def transform_column(df: DataFrame, col: str, kind: str, out: str | None = None) -> DataFrame:
    """log, inverse_log, exp, lognormal_density or standardize (sample deviation)."""
    x = F.col(col)
    if kind == "log":
        value = F.when(x > 0, F.ln(x))
    elif kind == "inverse_log":
        value = F.when(x > 0, F.try_divide(F.lit(1.0), F.ln(x)))
    elif kind == "exp":
        value = F.exp(x)
    elif kind == "lognormal_density":
        value = F.when(x > 0, F.exp(-F.pow(F.ln(x), 2) / 2) / (x * math.sqrt(2 * math.pi))).when(x <= 0, 0.0)
    elif kind == "standardize":
        s = df.agg(F.struct(F.avg(x).alias("m"), F.stddev_samp(x).alias("s"))).scalar()
        value = F.try_divide(x - s["m"], s["s"])
    else:
        raise ValueError(f"unknown kind {kind}")
    return df.withColumn(out or col, value)


def assert_unique_key(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once; empty when the key is unique."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def compound_growth(df: DataFrame, start: str, pct: float, day: int, target: str | None = None) -> DataFrame:
    """Amount on a day (day 1 is the start) and, when a target column is given, the first day that reaches it."""
    rate = 1 + pct / 100
    out = df.withColumn("amount", F.col(start) * F.pow(F.lit(rate), F.lit(day - 1)))
    if target is None:
        return out
    days = F.ceil(F.ln(F.col(target) / F.col(start)) / math.log(rate)) + 1
    reach = F.when(F.col(target) <= F.col(start), F.lit(1)).when(F.col(start) > 0, days)
    return out.withColumn("first_day", reach.cast("long"))
