"""Mask and unmask a column with built-in AES expressions.

Tokens are randomised: one value never gives the same token twice, so a masked
column can be neither joined nor grouped. Unmask first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.config import MaskKey
from barmill.functions import crypto


def mask(
    df: DataFrame,
    key: MaskKey,
    column: str = "Ticker",
    token: str = "fernet",
    unique: Sequence[str] = (),
) -> DataFrame:
    """Replace a string column by tokens; null stays null.

    ``unique`` names columns that tell rows apart; tokens then hang on them and
    not on the order of rows.
    """
    row = F.to_json(F.struct(*unique)) if unique else None
    if token == "gcm":
        return df.withColumn(column, crypto.gcm_seal(F.col(column), key, row))
    body = df.withColumn("_body", crypto.fernet_body(F.col(column), key, row=row))
    return body.withColumn(column, crypto.fernet_sign(F.col("_body"), key)).drop("_body")


def unmask(
    df: DataFrame,
    key: MaskKey,
    column: str = "Ticker",
    token: str = "fernet",
    bad_token: str = "null",
) -> DataFrame:
    """Replace a token column by its plain text.

    A token that is damaged or made with another key gives null, or fails the
    job with ``bad_token="raise"``.
    """
    if token == "gcm":
        plain = df.withColumn("_plain", crypto.gcm_open(F.col(column), key))
        opened = F.col("_plain")
        helpers = ("_plain",)
    else:
        raw = df.withColumn("_raw", crypto.from_token(F.col(column)))
        plain = raw.withColumn("_body", crypto.fernet_signed_part(F.col("_raw")))
        opened = F.when(
            crypto.fernet_is_valid(F.col("_raw"), F.col("_body"), key),
            crypto.fernet_open(F.col("_body"), key),
        )
        helpers = ("_raw", "_body")
    if bad_token == "raise":
        wrong = F.raise_error(F.lit(f"invalid token in column {column}")).cast("string")
        opened = F.when(F.col(column).isNotNull(), F.coalesce(opened, wrong))
    return plain.withColumn(column, opened).drop(*helpers)


def unmask_last(df: DataFrame, key: MaskKey, column: str = "Ticker", **options: str) -> DataFrame:
    """``unmask``, with the clear column moved to the end of the row."""
    others = [c for c in df.columns if c != column]
    return unmask(df, key, column, **options).select(*others, column)
