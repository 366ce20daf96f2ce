"""Readers: archives with fixed schemas, text files, and archives that may not exist yet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnocast.operators.ranking import sized
from limnocast.schemas import FORECAST_SCHEMA, MET_SCHEMA, SCORE_SCHEMA, TARGET_SCHEMA, conform
from limnocast.session import checkpointed
from limnocast.sources.catalogue import MONTH, header_catalogue


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    """Forecast archive; site, model and issue date come from the folder names.

    A given schema means no file is opened for inference, and files that lack a
    column or disagree on it read as nulls of one type.
    """
    return spark.read.schema(FORECAST_SCHEMA).parquet(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Any tree of Parquet files, partition columns found on the way down."""
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The archive at ``path``, or no rows when nothing has been written there yet."""
    try:
        return conform(spark.read.schema(schema).parquet(path), schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_layout(spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str]) -> DataFrame:
    """An archive stored by ``partitions``, with its ``month`` where that is one of them, so that months can be pruned."""
    extra = [T.StructField(MONTH, T.StringType())] if MONTH in partitions else []
    return read_or_empty(spark, path, T.StructType([*schema.fields, *extra]))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Stored scores that have an observation; none when nothing is scored yet."""
    return read_or_empty(spark, path, SCORE_SCHEMA).where(F.col("observation").isNotNull())


def read_met(spark: SparkSession, path: str) -> DataFrame:
    """Stored weather drivers, or none."""
    return read_or_empty(spark, path, MET_SCHEMA)


def read_by_name(
    spark: SparkSession, path: str, schema: T.StructType, extra: Sequence[str] = ()
) -> DataFrame:
    """CSV columns picked by the names in the header, in any order, and cast to ``schema``.

    ``extra`` names further columns to keep, as text, where the file has them. A column the file lacks is null,
    and so is ``NA``, an empty field and what cannot be cast. Files whose headers disagree are an error.
    """
    text = spark.read.csv(path, header=True, nullValue="NA", enforceSchema=False)

    def column(name: str, kind: T.DataType) -> Column:
        if name not in text.columns:
            return F.lit(None).cast(kind).alias(name)
        return F.nullif(F.col(f"`{name}`"), F.lit("")).try_cast(kind).alias(name)

    more = [c for c in extra if c in text.columns and c not in schema.names]
    return text.select(*[column(f.name, f.dataType) for f in schema.fields], *[column(c, T.StringType()) for c in more])


def read_targets(spark: SparkSession, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """Observations from CSV, ``NA`` as null, null observations dropped; see ``read_by_name``."""
    return with_observation(read_by_name(spark, path, TARGET_SCHEMA, extra))


def with_observation(targets: DataFrame) -> DataFrame:
    return targets.where(F.col("observation").isNotNull())


def read_raw_observations(spark: SparkSession, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """Raw observation CSV: every column text but depth and observation."""
    schema = T.StructType(
        [
            T.StructField(f.name, f.dataType if f.name in ("depth", "observation") else T.StringType())
            for f in TARGET_SCHEMA.fields
        ]
    )
    return read_by_name(spark, path, schema, extra)


def normalise_targets(raw: DataFrame, kind: str = "timestamp") -> DataFrame:
    """Parse the time and keep a depth for temperature only."""
    return raw.withColumns(
        {
            "datetime": F.col("datetime").cast(kind),
            "depth": F.when(F.col("variable") == "temperature", F.col("depth")),
        }
    )


def read_member_files(spark: SparkSession, folder: str, model: str) -> DataFrame:
    """Wide weather files of all members, ``met_<model>_<member>.csv``, member from the name.

    A member may be a file or a folder of part files of that name. Columns are picked by each file's own header, so files may
    differ in the order of their columns and in what else they hold; see ``read_differing``. No matching file
    gives no rows.
    """
    prefix = f"met_{model}_"
    schema = T.StructType(
        [
            T.StructField("time", T.TimestampType()),
            T.StructField("AirTemp", T.DoubleType()),
            T.StructField("WindSpeed", T.DoubleType()),
        ]
    )
    text = read_differing(spark, f"{folder.rstrip('/')}/{prefix}*.csv", schema)
    member = F.regexp_extract("file", f"/{re.escape(prefix)}([^/]*)[.]csv", 1)
    return text.select(*schema.names, F.url_decode(F.replace(member, F.lit("+"), F.lit("%2B"))).alias("parameter"))


def read_differing(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """Rows of CSV files whose headers may differ: ``schema``'s columns by each file's own names, and ``file``.

    The first lines of all files give a catalogue of names, one row per file, and the distinct headers among them decide
    which fields of a line are which. All files are then read in one scan, whatever the number of headers. A column that
    a file lacks is null in its rows, and so is ``NA``, an empty field and what cannot be cast.
    """
    try:
        heads = header_catalogue(spark, pattern)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file", T.StringType())]))
        raise
    heads = checkpointed(heads)
    width = heads.agg(F.max(F.size("names"))).first()[0] or 1
    fields = [f"_c{i}" for i in range(width)]
    places = heads.select("file", *[F.array_position("names", F.lit(f.name)).cast("int").alias(f"_at_{f.name}") for f in schema.fields])
    # A header line is left out at the start of every file; names are set aside, places count.
    lines = spark.read.schema(", ".join(f"{f} string" for f in fields)).csv(pattern, header=True, nullValue="NA")
    lines = lines.select(F.array(*fields).alias("_line"), F.col("_metadata.file_path").alias("file"))
    joined = lines.join(sized(places), "file")

    def column(f: T.StructField) -> Column:
        at = F.col(f"_at_{f.name}")
        text = F.when(at > 0, F.get("_line", at - 1))
        return F.nullif(text, F.lit("")).try_cast(f.dataType).alias(f.name)

    return joined.select(*[column(f) for f in schema.fields], "file")


def stored_dates(archive: DataFrame, site_id: str) -> DataFrame:
    """Issue dates an archive already holds for a site, by a scan that reads no data column."""
    return (
        archive.where(F.col("site_id") == site_id)
        .select(F.to_date("reference_datetime").alias("reference_datetime"))
        .distinct()
    )
