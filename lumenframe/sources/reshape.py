"""Nested or matrix input to plain tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix_to_edges(df: DataFrame, key: str, row: str) -> DataFrame:
    """Adjacency rows (array per node) to undirected edges with their weight; zeros are dropped."""
    cells = df.select(F.col(key).cast("bigint").alias("i"), F.posexplode(row).alias("j", "w")).where("w <> 0")
    return cells.select(F.least("i", F.col("j").cast("bigint")).alias("src"), F.greatest("i", F.col("j").cast("bigint")).alias("dst"),
                        F.col("w").cast("double").alias("weight")).groupBy("src", "dst").agg(F.max("weight").alias("weight"))


def flatten_json_items(df: DataFrame, col: str, fields: dict[str, str], *keep: str, items: str = "items") -> DataFrame:
    """One row per object in the JSON array `items`, with the given fields as name -> type."""
    inner = ", ".join(f"`{n}`: {t}" for n, t in fields.items())
    parsed = F.from_json(col, f"`{items}` array<struct<{inner}>>".replace("`: ", "`:"))
    return df.select(*keep, F.inline(parsed[items]))


def decode_code_files(df: DataFrame, path: str, content: str, ext: str) -> DataFrame:
    """Files with the extension: path, file name and the base64 content as text."""
    kept = df.where(F.substring_index(path, ".", -1) == ext)
    return kept.select(path, F.substring_index(path, "/", -1).alias("file_name"),
                       F.decode(F.unbase64(content), "UTF-8").alias("code"))
