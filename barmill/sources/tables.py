"""Stored tables: day-partitioned scans and sinks, local rows, serving reads."""

from __future__ import annotations

import warnings
from collections.abc import Collection, Iterable, Sequence
from datetime import date
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.functions.measures import nan_to_null
from barmill.operators.serving import stack
from barmill.schemas import PARTITION


# Error conditions that mean "there is no table here yet".
MISSING = ("PATH_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST", "DELTA_MISSING_DELTA_TABLE")

# Formats that keep the schema themselves and refuse another one.
SELF_DESCRIBING = ("delta",)


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PARTITION, T.DateType())])


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder that the session names for checkpoints, else one in the warehouse.

    A folder on the driver's own disk is of no use to the executors of a cluster, so that is warned of.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    local = folder.startswith("file:") or "://" not in folder
    if local and not spark.sparkContext.master.startswith("local"):
        warnings.warn(f"{folder} is a local folder; set spark.checkpoint.dir to one that all executors share", stacklevel=2)
    return folder.rstrip("/")


def is_missing(error: Exception) -> bool:
    """Whether reading failed because there is no table yet."""
    return isinstance(error, AnalysisException) and error.getCondition() in MISSING


def find_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame | None:
    """Scan a table written by ``write_days``; ``None`` when there is none yet.

    The partition column stays: filter on ``p_date`` to prune days, and drop it
    with ``data_columns``.
    """
    reader = spark.read.format(fmt)
    if fmt not in SELF_DESCRIBING:
        reader = reader.schema(_stored(schema))
    try:
        return reader.load(path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """``find_table``, where a missing table reads as an empty one."""
    found = find_table(spark, path, schema, fmt)
    return spark.createDataFrame([], _stored(schema)) if found is None else found


def data_columns(df: DataFrame) -> DataFrame:
    return df.drop(PARTITION)


def spread_days(df: DataFrame) -> DataFrame:
    """Shuffle rows by day for a day-partitioned write.

    The rebalance hint lets adaptive execution split a day that is too big for
    one task and merge days that are tiny, so files come out near the advisory
    size whatever the distribution.
    """
    return df.withColumn(PARTITION, F.to_date("Date")).hint("rebalance", PARTITION)


def sort_days(df: DataFrame, *order: str) -> DataFrame:
    """Sort inside each task: one open file at a time, narrow ``Date`` ranges."""
    return df.withColumn(PARTITION, F.to_date("Date")).sortWithinPartitions(
        PARTITION, *(order or ("Date",))
    )


def by_day(df: DataFrame) -> DataFrame:
    """Lay rows out for ``write_days``."""
    return sort_days(spread_days(df))


def by_instrument(df: DataFrame) -> DataFrame:
    """Lay rows out for ``write_days`` so that one instrument's rows lie together.

    Rows are dealt by ranges of day and instrument, so a hot day is split
    between instruments, and sorted by instrument in each task: a reader of one
    instrument skips the row groups of the others by their statistics.
    """
    placed = df.withColumn(PARTITION, F.to_date("Date"))
    return placed.repartitionByRange(PARTITION, "Ticker", "Date").sortWithinPartitions(PARTITION, "Ticker", "Date")


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Save a frame as a catalog table on ``path``, dealt into buckets by a hash of ``keys`` and sorted by them.

    Tables with the same keys and number of buckets join on the keys without a
    shuffle. Rows are dealt before the write, so each bucket is one file; a key
    that dominates stays in one bucket, which suits keys such as an
    instrument's day that are small by nature.
    """
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def write_days(
    df: DataFrame, path: str, mode: str, fmt: str = "parquet", first: date | None = None,
    days: Collection[date] | None = None,
) -> None:
    """Write a frame laid out by ``by_day`` or ``sort_days``.

    ``append`` adds files. ``overwrite`` replaces the days from ``first`` on,
    all of them without it, or just ``days``, by those of the frame, which must
    hold them whole. Formats that can replace a range do so; elsewhere Spark
    replaces the days present in the frame, and ``drop_days`` empties those
    that have no rows any more.
    """
    writer = df.write.format(fmt).partitionBy(PARTITION)
    if mode != "overwrite":
        writer = writer.mode("append")
    elif fmt in SELF_DESCRIBING:
        writer = writer.mode("overwrite")
        if days is not None:
            listed = ", ".join(f"DATE '{day}'" for day in sorted(days))
            writer = writer.option("replaceWhere", f"{PARTITION} IN ({listed})")
        elif first is not None:
            writer = writer.option("replaceWhere", f"{PARTITION} >= DATE '{first}'")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def stored_days(
    table: DataFrame | None, first: date | None, among: Collection[date] | None = None
) -> set[date]:
    """Days of a stored table from ``first`` on, or those ``among`` some; at most one value for each calendar day."""
    if table is None:
        return set()
    rows = table.select(PARTITION)
    if among is not None:
        rows = rows.filter(F.col(PARTITION).isin([F.lit(d) for d in sorted(among)]))
    elif first is not None:
        rows = rows.filter(F.col(PARTITION) >= F.lit(first))
    return {row[0] for row in rows.distinct().collect()}


def drop_days(spark: SparkSession, path: str, days: Iterable[date]) -> None:
    """Empty whole day partitions of a table whose format has no range replacement.

    Each is overwritten with no line of text, through Spark's own writer: what
    stays is a file without a byte, which scans, listings and ``serving_table``
    pass over.
    """
    nothing = spark.createDataFrame([], "value string").coalesce(1)
    for day in sorted(days):
        nothing.write.mode("overwrite").text(f"{path}/{PARTITION}={day.isoformat()}")


def listed_days(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """``p_date`` of the days that have files, from the listing alone; ``None`` where there is no table.

    No data file is opened, not even its footer. A format that keeps its own
    list of files answers from its partition column.
    """
    reader = spark.read.format("binaryFile" if fmt not in SELF_DESCRIBING else fmt)
    try:
        listing = reader.load(path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None
    if PARTITION not in listing.columns:
        return spark.createDataFrame([], T.StructType([T.StructField(PARTITION, T.DateType())]))
    files = listing if fmt in SELF_DESCRIBING else listing.where("length > 0")
    return files.select(F.col(PARTITION).cast("date").alias(PARTITION)).distinct()


def append_lines(lines: DataFrame, path: str, by: str | None = None) -> None:
    """Append a string frame to a text log, in a folder for each value of ``by``."""
    writer = lines.coalesce(1).write.mode("append")
    (writer.partitionBy(by) if by else writer).text(path)


def from_rows(spark: SparkSession, rows: Iterable[Any], schema: T.StructType) -> DataFrame:
    """A frame from a handful of driver rows, with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def from_pandas(spark: SparkSession, pdf: Any, schema: T.StructType) -> DataFrame:
    """A frame from a small pandas frame; NaN becomes null on every path."""
    df = spark.createDataFrame(pdf, schema)
    floats = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df


def serving_table(spark: SparkSession, *roots: str, fmt: str = "parquet") -> DataFrame:
    """All partitions of one or more tables stacked into one frame.

    Only data files count: log folders and other files are left out. The
    columns are those of all files, so one that later loads add is kept; a
    column whose type has changed between loads has the type that holds all.
    """
    parts = [_all_columns(spark, root, fmt) for root in roots]
    return data_columns(stack(*widened(parts)))


def _all_columns(spark: SparkSession, root: str, fmt: str) -> DataFrame:
    if fmt in SELF_DESCRIBING:
        return spark.read.format(fmt).load(root)
    try:
        return spark.read.format(fmt).option("pathGlobFilter", f"*.{fmt}").option("mergeSchema", "true").load(root)
    except AnalysisException as error:
        if is_missing(error):
            raise
        return reconciled(spark, root, fmt)
    except Py4JJavaError as error:  # footers are merged in tasks as well, whose failure has no condition
        if "merge" not in str(error):
            raise
        return reconciled(spark, root, fmt)


def reconciled(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """A table of files whose column types differ, each column in the type that holds all of them.

    Types change between loads, so files in order of time fall into a few runs
    of one type. The runs are found by halving, read with their own types, cast
    and stacked. File names and schemas go through the driver, as for any scan.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").load(root).where("length > 0")
    files = [r[0] for r in listed.orderBy("modificationTime", "path").select("path").collect()]

    def opened(some: list[str]) -> DataFrame:
        return spark.read.format(fmt).option("mergeSchema", "true").option("basePath", root).load(some)

    def runs(some: list[str]) -> list[DataFrame]:
        try:
            return [opened(some)]
        except (AnalysisException, Py4JJavaError):
            if len(some) == 1:
                raise
            half = len(some) // 2
            return runs(some[:half]) + runs(some[half:])

    return stack(*widened(runs(files)))


def widened(parts: Sequence[DataFrame]) -> list[DataFrame]:
    """Frames whose columns of one name have one type: the least that holds every value of all of them."""
    kinds: dict[str, T.DataType] = {}
    for part in parts:
        for f in part.schema.fields:
            kinds[f.name] = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return [
        part.select(*(F.col(f"`{f.name}`").cast(kinds[f.name]).alias(f.name) for f in part.schema.fields)) for part in parts
    ]


# Types in order of what they hold.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, a time for dates and times, else text."""
    if a == b:
        return a
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    times = (T.DateType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    return T.StringType()


def day_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``p_date``, ``files`` and ``bytes`` of each stored day, from the listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").load(path).where("length > 0")
    return listed.groupBy(F.col(PARTITION).cast("date").alias(PARTITION)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
