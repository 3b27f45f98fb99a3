"""Small helpers that the operators of this subpackage share."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumenframe.functions.ordering import fresh_path, shared_folder

#: ASCII white space, as the contracts of the text operators define it.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def landed(df: DataFrame, label: str) -> DataFrame:
    """Written once below the shared folder and read back: fixes the rows, cuts lineage, survives lost executors."""
    spark = df.sparkSession
    shared_folder(spark)
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def extended(df: DataFrame, **kinds: str) -> StructType:
    """The schema of df with further columns."""
    out = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out
