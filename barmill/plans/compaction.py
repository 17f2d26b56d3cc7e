"""Days with many small files rewritten into few.

Appended loads leave a file or more each in a day. The days that have too many are copied to a folder beside the layers,
and then replaced by their copy. The copy is noted with what it reaches up to before anything is replaced, so a run that
breaks off is taken up by the next one: it starts from the copy and what loads have added since.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill import schemas
from barmill.config import RunConfig
from barmill.plans import ledger
from barmill.plans.layers import on_days
from barmill.plans.medallion import open_layer, with_known_labels
from barmill.schemas import INGESTED, PARTITION
from barmill.sources.tables import (
    SELF_DESCRIBING, by_day, by_instrument, day_files, find_table, read_table, sort_days, write_days,
)

#: Bytes of a file that is large enough.
ENOUGH = 128 << 20


def scattered_days(spark: SparkSession, cfg: RunConfig, layer: str, least: int = 8, enough: int = ENOUGH) -> set[date]:
    """Days with at least ``least`` files, most of which are needless at ``enough`` bytes a file."""
    files = day_files(spark, cfg.table(layer), cfg.fmt)
    many = files.filter((F.col("files") >= least) & (F.col("files") > 2 * F.ceil(F.col("bytes") / enough)))
    return {r[0] for r in many.select(PARTITION).collect()}


def compact(spark: SparkSession, cfg: RunConfig, layer: str, least: int = 8, enough: int = ENOUGH) -> set[date]:
    """Rewrite the scattered days of a layer; the days that were rewritten are returned.

    Rows stay the same. No load may write the layer meanwhile.
    """
    if cfg.fmt in SELF_DESCRIBING:
        raise ValueError(f"{cfg.fmt} tables have a compaction of their own")
    cfg = with_known_labels(spark, cfg)
    if find_table(spark, cfg.table(layer), cfg.stored_schema(layer), cfg.fmt) is None:
        return set()
    done = set()
    left = ledger.unfinished_copy(spark, cfg, layer)
    if left:
        folder, upto, days = left
        copy = read_table(spark, folder, cfg.stored_schema(layer), cfg.fmt)
        since = on_days(open_layer(spark, cfg, layer), days).filter(F.col(_reach(layer)) > F.lit(upto).cast("timestamp_ntz"))
        done |= _replace(spark, cfg, layer, copy.unionByName(since), days)
        ledger.copy_noted(spark, cfg, layer, folder, "replaced", upto, days)
    days = scattered_days(spark, cfg, layer, least, enough) - done
    if days:
        done |= _replace(spark, cfg, layer, on_days(open_layer(spark, cfg, layer), days), days)
    return done


def _reach(layer: str) -> str:
    """The column in which later loads go beyond earlier ones."""
    return INGESTED if layer == "bronze" else "Date"


def _replace(spark: SparkSession, cfg: RunConfig, layer: str, rows: DataFrame, days: set[date]) -> set[date]:
    folder = f"{cfg.ledger('compaction')}/{uuid.uuid4().hex}"
    write_days(_laid_out(rows, cfg, layer), folder, "append", cfg.fmt)
    copy = read_table(spark, folder, cfg.stored_schema(layer), cfg.fmt)
    upto = copy.agg(F.max(_reach(layer))).first()[0]
    ledger.copy_noted(spark, cfg, layer, folder, "copied", upto, days)
    write_days(_laid_out(copy, cfg, layer), cfg.table(layer), "overwrite", cfg.fmt, days=days)
    ledger.copy_noted(spark, cfg, layer, folder, "replaced", upto, days)
    return days


def _laid_out(rows: DataFrame, cfg: RunConfig, layer: str) -> DataFrame:
    if layer == "gold" and cfg.gold_layout == "instrument":
        return by_instrument(rows)
    return sort_days(by_day(rows), "Date", *(("Ticker",) if layer == "bronze" else ()))
