"""Readers and writers."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str, columns: list[str] | None = None,
             encoding: str = "UTF-8", null_value: str = "", header: bool = True, multi_line: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a given schema; only the named columns are parsed, and a line that does not fit is an error.

    Values with line breaks need multi_line, which makes every file one task: write many files of moderate size then.
    """
    df = (spark.read.schema(schema).option("header", header).option("encoding", encoding).option("nullValue", null_value)
          .option("escape", '"').option("multiLine", multi_line).option("mode", mode).csv(path))
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return df.limit(limit) if limit is not None else df


def read_labelled_text_dir(spark: SparkSession, root: str, label_map: dict[str, int] | None = None,
                           label_pattern: str = r"([^/]+)/[^/]+$", glob: str = "*") -> DataFrame:
    """One row per file, whatever its ending unless `glob` says so: path, text and a label from the parent folder, mapped
    when a mapping is given."""
    # partition folders such as name=value stay plain folders because the lookup is recursive
    files = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=True)
             .select(F.input_file_name().alias("path"), F.col("value").alias("text")))
    label = F.regexp_extract("path", label_pattern, 1)
    if label_map:
        label = F.try_element_at(F.create_map(*[F.lit(x) for kv in label_map.items() for x in kv]), label)
    return files.withColumn("label", label)


def read_binary_dir(spark: SparkSession, root: str, label_pattern: str, glob: str = "*") -> DataFrame:
    """One row per file: path, size, content and a label from the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", F.col("length").alias("size"), "content", F.regexp_extract("path", label_pattern, 1).alias("label"))


def read_edge_list(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """src,dst,cost lines without a header; any line end."""
    return spark.read.schema(f"src {id_type}, dst {id_type}, cost double").csv(path)


def load_wordlist(spark: SparkSession, path: str, extra: Iterable[str] = ()) -> DataFrame:
    """Distinct words of a one-word-per-line file, right-trimmed, and extra words."""
    words = spark.read.text(path).select(F.rtrim("value").alias("word"))
    extra = [(w,) for w in extra]
    if extra:
        words = words.unionByName(spark.createDataFrame(extra, "word string"))
    return words.where("word <> ''").distinct()


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8 CSV with a header; quotes inside values are doubled."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
