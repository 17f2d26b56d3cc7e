"""What loads have read, changed and seen, in small tables beside the layers.

Rows are only ever appended, and only after the data they speak of is stored. A run that dies in between does its
part again: a file is read twice, into copies of which the later one counts, or a day is computed twice.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill import schemas
from barmill.config import Granularity, RunConfig
from barmill.sources.landing import landing_files
from barmill.sources.tables import SELF_DESCRIBING, from_rows, is_missing

FILES, DAYS, PROGRESS, LABELS, COPIES = "files", "changed_days", "progress", "labels", "compactions"

#: More labels than this cannot be columns.
MOST_LABELS = 1000


def _read(spark: SparkSession, cfg: RunConfig, name: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(cfg.ledger(name))
    except Exception as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def _append(rows: DataFrame, cfg: RunConfig, name: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(cfg.ledger(name))


def _own(name: str, cfg: RunConfig) -> str:
    return f"{name}_{cfg.granularity.name}"


# --- landing files ---------------------------------------------------------


def new_files(spark: SparkSession, cfg: RunConfig) -> list[tuple[str, datetime, int]]:
    """Files of the landing table that no load has read as they are now, by name.

    A file that was written anew counts as another one. The list goes through the driver, as any file list of a scan
    does; it holds the files since the last load.
    """
    if cfg.fmt in SELF_DESCRIBING:
        raise ValueError(f"a landing table in {cfg.fmt} format is no set of files; consume it by dates")
    read = _read(spark, cfg, _own(FILES, cfg), schemas.CONSUMED_FILES)
    keys = ["path", "modified", "size"]
    found = landing_files(spark, cfg.landing, cfg.fmt).join(read.select(*keys), keys, "left_anti")
    return [tuple(r) for r in found.orderBy("path").collect()]


def files_read(spark: SparkSession, cfg: RunConfig, files: Iterable[tuple[str, datetime, int]], stamp: datetime) -> None:
    rows = [(*file, stamp) for file in files]
    if rows:
        _append(from_rows(spark, rows, schemas.CONSUMED_FILES), cfg, _own(FILES, cfg))


# --- changed days ----------------------------------------------------------


def days_changed(spark: SparkSession, cfg: RunConfig, layer: str, days: Iterable[date], stamp: datetime) -> None:
    rows = [(layer, cfg.granularity.name, stamp, day) for day in sorted(days)]
    if rows:
        _append(from_rows(spark, rows, schemas.CHANGED_DAYS), cfg, DAYS)


def pending(
    spark: SparkSession, cfg: RunConfig, layer: str, source: str, granularity: Granularity | None = None
) -> tuple[set[date], datetime | None]:
    """Days of the source layer that changed since this layer last got through, and the stamp of the latest change."""
    of = (granularity or cfg.granularity).name
    done = _read(spark, cfg, PROGRESS, schemas.PROGRESS).filter(
        (F.col("layer") == layer) & (F.col("granularity") == cfg.granularity.name)
        & (F.col("source") == source) & (F.col("source_granularity") == of)
    ).agg(F.max("upto")).first()[0]
    changed = _read(spark, cfg, DAYS, schemas.CHANGED_DAYS).filter((F.col("layer") == source) & (F.col("granularity") == of))
    if done is not None:
        changed = changed.filter(F.col("stamp") > F.lit(done).cast("timestamp_ntz"))
    rows = changed.groupBy("day").agg(F.max("stamp").alias("stamp")).collect()  # one row a calendar day at most
    return {r["day"] for r in rows}, max((r["stamp"] for r in rows), default=None)


def got_through(
    spark: SparkSession, cfg: RunConfig, layer: str, sources: Iterable[tuple[str, Granularity, datetime | None]]
) -> None:
    rows = [(layer, cfg.granularity.name, source, of.name, upto) for source, of, upto in sources if upto is not None]
    if rows:
        _append(from_rows(spark, rows, schemas.PROGRESS), cfg, PROGRESS)


# --- labels ----------------------------------------------------------------


def known_labels(spark: SparkSession, cfg: RunConfig) -> list[str]:
    """Labels that bronze has met, in the order of their first load."""
    seen = _read(spark, cfg, _own(LABELS, cfg), schemas.SEEN_LABELS)
    first = seen.groupBy("label").agg(F.min("stamp").alias("stamp")).collect()  # MOST_LABELS at most
    return [r["label"] for r in sorted(first, key=lambda r: (r["stamp"], r["label"]))]


def labels_seen(spark: SparkSession, cfg: RunConfig, labels: Iterable[str], stamp: datetime) -> list[str]:
    """Add labels to the registry; those that were not there are returned."""
    known = set(known_labels(spark, cfg))
    new = sorted(set(labels) - known)
    if len(known) + len(new) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels cannot be columns: {new[:5]}")
    if new:
        _append(from_rows(spark, [(label, stamp) for label in new], schemas.SEEN_LABELS), cfg, _own(LABELS, cfg))
    return new


# --- compaction ------------------------------------------------------------


def copy_noted(
    spark: SparkSession, cfg: RunConfig, layer: str, folder: str, state: str, upto: datetime | None, days: Iterable[date]
) -> None:
    """Note a copy of some days as ``copied`` or ``replaced``."""
    rows = [(layer, cfg.granularity.name, folder, state, upto, day) for day in sorted(days)]
    _append(from_rows(spark, rows, schemas.COMPACTIONS), cfg, COPIES)


def unfinished_copy(spark: SparkSession, cfg: RunConfig, layer: str) -> tuple[str, datetime, set[date]] | None:
    """The folder, reach and days of a copy that has not replaced its days yet; there is one at most."""
    noted = _read(spark, cfg, COPIES, schemas.COMPACTIONS).filter(
        (F.col("layer") == layer) & (F.col("granularity") == cfg.granularity.name)
    )
    ready = noted.filter("state = 'replaced'").select("folder").distinct()
    rows = noted.join(ready, "folder", "left_anti").collect()  # the days of one copy
    return (rows[0]["folder"], rows[0]["upto"], {r["day"] for r in rows}) if rows else None
