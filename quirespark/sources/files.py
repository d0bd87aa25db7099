"""JSON, JSON lines, YAML packs, binary documents and bundles as DataFrames."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_records(spark: SparkSession, path: str, schema: StructType | str, lines: bool = False) -> DataFrame:
    """Records of declared schema; a malformed one fails the read.  Blank lines of JSON lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", str(not lines).lower()).json(path)


def raw_json(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as VARIANT values."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.parse_json("value").alias("value"))


def yaml_pack(path: str) -> dict:
    """A configuration pack of the driver: missing, empty and non-mapping files are errors."""
    import yaml

    if not os.path.exists(path):
        raise FileNotFoundError(path)
    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f)
    if data is None:
        raise ValueError(f"{path} is empty")
    if not isinstance(data, dict):
        raise ValueError(f"{path} is no mapping")
    return data


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Binary documents with their hash and size; the content itself is read by what needs it."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("file_size_bytes"), F.col("modificationTime").alias("modified_at"))


def font_flags(flags):
    """Bold, italic and monospaced of the flag bits of a span."""
    bit = lambda n: flags.bitwiseAND(F.lit(1 << n)) != 0
    return F.struct(bit(4).alias("is_bold"), bit(1).alias("is_italic"), bit(0).alias("is_monospace"))


def font_bits(flags: int) -> tuple[bool, bool, bool]:
    """:func:`font_flags` of a number."""
    return bool(flags & 16), bool(flags & 2), bool(flags & 1)


def first_strategy(tables: DataFrame, order: tuple[str, ...] = ("lines_strict", "lines", "text")) -> DataFrame:
    """Of the tables that several strategies found on a page those of the first strategy that found any; NULL cells become empty."""
    rank = F.coalesce(*[F.when(F.col("extraction_strategy") == s, F.lit(k)) for k, s in enumerate(order)], F.lit(len(order)))
    best = tables.withColumn("__rank", rank).groupBy("doc_id", "page_number").agg(F.min("__rank").alias("__best"))
    return tables.withColumn("__rank", rank).join(best, ["doc_id", "page_number"]).where("__rank = __best").drop("__rank", "__best")


def parse_pages(text: str) -> list[int]:
    """``1,5,8-12`` as sorted distinct page numbers."""
    found: set[int] = set()
    for part in text.split(","):
        part = part.strip()
        if not part:
            continue
        first, dash, last = part.partition("-")
        a = int(first)
        b = int(last) if dash else a
        if a < 1 or b < a:
            raise ValueError(f"no page range: {part}")
        found.update(range(a, b + 1))
    if not found:
        raise ValueError("no pages given")
    return sorted(found)


def keep_pages(df: DataFrame, pages: list[int] | None, page: str = "page_number") -> DataFrame:
    """Rows of the given pages; the filter reaches the scan.  None keeps all."""
    return df if pages is None else df.where(F.col(page).isin([int(p) for p in pages]))
