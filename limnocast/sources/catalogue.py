"""What an archive holds, by its listing: names, sizes and times of files. No data file is opened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the folder name that stands for a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

#: The level of months under the partitions of archives that grow from day to day.
MONTH = "month"


def folder_value(path: Column, name: str) -> Column:
    """The value of a partition column as the folders of a file's path spell it."""
    text = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
    # Folder names escape by %XX only, so a plus is a plus.
    return F.when(text != NULL_FOLDER, F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))))


def stored_files(spark: SparkSession, path: str, partitions: Sequence[str], glob: str = "*.parquet", **fixed: str) -> DataFrame:
    """``(partition columns as text, folder, file, length, modified)`` of the files of an archive.

    ``fixed`` gives values of some partition columns; only folders of those names are listed. The listing is Spark's own, in
    parallel for many folders, and the content of a file is a column that nothing reads. No archive gives no rows.
    """
    below = ""
    if fixed:
        last = max(i for i, p in enumerate(partitions) if p in fixed)
        below = "".join(f"/{p}={fixed[p]}" if p in fixed else f"/{p}=*" for p in partitions[: last + 1])
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(path.rstrip("/") + below)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            names = "".join(f"`{p}` string, " for p in partitions)
            return spark.createDataFrame([], f"{names}folder string, file string, length long, modified timestamp")
        raise
    where = F.col("path")
    return files.select(
        *[folder_value(where, p).alias(p) for p in partitions],
        F.regexp_replace(where, "/[^/]*$", "").alias("folder"),
        where.alias("file"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def stored_partitions(spark: SparkSession, path: str, partitions: Sequence[str], **fixed: str) -> DataFrame:
    """One row per partition: its ``folder``, ``files``, ``bytes``, ``newest``, and a ``mark`` that any rewrite changes."""
    files = stored_files(spark, path, partitions, **fixed)
    return files.groupBy(*partitions, "folder").agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modified").alias("newest"),
        F.bit_xor(F.xxhash64("file", "length", "modified")).alias("mark"),
    )


def listed_dates(spark: SparkSession, path: str, site_id: str, partitions: Sequence[str]) -> DataFrame:
    """Issue dates an archive holds for a site, from its folder names."""
    held = stored_files(spark, path, partitions, site_id=site_id)
    return held.select(F.to_date("reference_datetime").alias("reference_datetime")).distinct()


def is_by_month(spark: SparkSession, path: str) -> bool | None:
    """Whether the files of an archive lie under months; None where nothing is stored yet."""
    files = stored_files(spark, path, [MONTH])
    found = files.agg(F.count("*").alias("n"), F.count(F.when(F.contains("folder", F.lit(f"/{MONTH}=")), 1)).alias("monthly")).first()
    return None if not found["n"] else found["monthly"] > 0


def archive_partitions(spark: SparkSession, path: str, partitions: Sequence[str], by_month: bool | None = None) -> list[str]:
    """The partition columns an archive is stored by: ``partitions``, and months below them if it has that level or is new.

    ``by_month`` asks for one layout; an archive that is stored in the other must be migrated first.
    """
    stored = is_by_month(spark, path)
    if None not in (stored, by_month) and stored != by_month:
        raise ValueError(f"{path} is stored {'by' if stored else 'without'} months; migrate it first")
    monthly = next((x for x in (stored, by_month) if x is not None), True)
    return [*partitions, MONTH] if monthly else list(partitions)


def header_catalogue(spark: SparkSession, pattern: str) -> DataFrame:
    """``(file, names)``: the column names in the first line of every text file, in one distributed pass."""
    lines = spark.read.text(pattern).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    # Lines of a block come in order, so the first line of the first block has the least number.
    numbered = lines.withColumn("line", F.monotonically_increasing_id()).where("block = 0")
    first = numbered.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    plain = F.regexp_replace("header", "^﻿", "")
    width = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    most = first.agg(F.max(width)).first()[0] or 1
    # Parsed like a line of data, so quoted names keep their commas.
    fields = [f"_c{i}" for i in range(most)]
    parsed = F.from_csv(plain, ", ".join(f"{f} string" for f in fields))
    return first.select("file", F.filter(F.array(*[F.trim(parsed[f]) for f in fields]), lambda x: x.isNotNull()).alias("names"))
