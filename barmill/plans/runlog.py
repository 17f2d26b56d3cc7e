"""Step messages of a run: a structured table and a plain text log."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.config import RunConfig
from barmill.schemas import RUN_LOG
from barmill.sources.tables import append_lines, from_rows


class RunLog:
    """Collects the few steps of a chain of stages and appends them at its end."""

    def __init__(self, cfg: RunConfig) -> None:
        self.cfg = cfg
        self.run_id = uuid.uuid4().hex
        self.rows: list[tuple] = []

    def add(
        self,
        layer: str,
        step: str,
        ts: datetime,
        message: str,
        status: str = "ok",
        rows_out: int | None = None,
    ) -> None:
        name = self.cfg.granularity.name
        self.rows.append((self.run_id, layer, name, step, ts, status, rows_out, message))

    def save(self, spark: SparkSession) -> None:
        rows, self.rows = self.rows, []
        log = from_rows(spark, rows, RUN_LOG).coalesce(1)
        log.write.mode("append").format(self.cfg.fmt).save(self.cfg.run_log())
        append_lines(as_lines(log), self.cfg.text_log(), by="layer")

    def save_after(self, spark: SparkSession, error: BaseException | None) -> None:
        """``save``; a log that cannot be written does not hide the error that ended the run."""
        try:
            self.save(spark)
        except Exception as failure:
            if error is None:
                raise
            error.add_note(f"the run log could not be saved: {type(failure).__name__}: {failure}")


def as_lines(log: DataFrame) -> DataFrame:
    """``<message>, <yyyy-MM-dd HH:mm:ss>`` per step, and its layer."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return log.select("layer", F.concat_ws(", ", "message", stamp).alias("Log"))


def read_run_log(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    return spark.read.schema(RUN_LOG).format(cfg.fmt).load(cfg.run_log())


def read_text_log(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """The lines of the text log with their layer."""
    lines = spark.read.text(cfg.text_log())
    return lines.select("layer", F.col("value").alias("Log"))
