"""What a run needs to know: granularity, tables, key and mode."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import types as T

from barmill import schemas


@dataclass(frozen=True)
class Granularity:
    """One of the two bar sizes; everything that differs between them."""

    name: str
    step: timedelta
    guard_hours: bool
    gold_hourly: bool


HOUR = Granularity("hourly", timedelta(hours=1), True, True)
DAY = Granularity("daily", timedelta(days=1), False, False)


@dataclass(frozen=True)
class MaskKey:
    """A 32-byte masking key: signing half first, encryption half second."""

    raw: bytes = field(repr=False)

    def __post_init__(self) -> None:
        if len(self.raw) != 32:
            raise ValueError(f"a mask key has 32 bytes, got {len(self.raw)}")

    @classmethod
    def from_text(cls, text: str | bytes) -> MaskKey:
        """Decode the usual URL-safe base64 spelling of a key."""
        return cls(base64.urlsafe_b64decode(text))

    @classmethod
    def from_env(cls, name: str) -> MaskKey:
        """Read the key from the environment; there is no default key."""
        return cls.from_text(os.environ[name])

    @property
    def signing(self) -> bytes:
        return self.raw[:16]

    @property
    def encryption(self) -> bytes:
        return self.raw[16:]


@dataclass(frozen=True)
class RunConfig:
    """Settings of one medallion, for one granularity.

    ``labels`` are the price labels that silver and gold carry as columns; the
    six usual ones come first. Rows of other labels stay in bronze and are
    counted in the run log. ``symbols`` names a table of tickers (``Ticker``),
    or a listing (``symbol``, ``country``) of which ``country``'s symbols up
    to ``longest_symbol`` characters are loaded. ``sequence`` names a landing
    column by which copies of a bar in one load are told apart, the last one
    counting.

    ``consume`` says what a bronze load takes from the landing table: bars
    ``"dates"`` after the last loaded one, or the ``"files"`` that no load has
    read yet, whatever their dates. ``late="recompute"`` makes silver and gold
    compute the days that loads have changed, and the days whose previous close
    lies on them, instead of the days from their last one on. With
    ``label_registry`` every label that bronze has met becomes a column, after
    those of ``labels``. ``gold_layout`` says what gold's files are sorted by:
    ``"time"``, or ``"instrument"`` for readers of single instruments.

    ``token="gcm"`` must not mask more than 2**32 rows with one key.

    ``lookback`` says where previous closes may come from: ``"history"`` (all
    loaded days) or ``"slice"`` (only the rows being loaded). ``write`` is
    ``"overwrite"`` (silver and gold replace whole days, so a rerun changes
    nothing) or ``"append"``. ``compat`` switches to the literal behaviour:
    slice, append, duplicates summed, missing change labelled as a fall, and a
    guard that looks at the weekday only.
    """

    root: str
    granularity: Granularity
    key: MaskKey
    landing: str | None = None
    fmt: str = "parquet"
    token: str = "fernet"
    bad_token: str = "null"
    lookback: str = "history"
    write: str = "overwrite"
    compat: bool = False
    guard: bool = True
    zone: str = "America/Sao_Paulo"
    trading_hours: tuple[int, int] = (12, 21)
    holidays: Iterable[date] | None = None
    symbols: str | None = None
    country: str = "brazil"
    longest_symbol: int | None = 5
    symbol_suffix: str = ".SA"
    labels: tuple[str, ...] = schemas.LABELS
    sequence: str | None = None
    consume: str = "dates"
    late: str = "leave"
    label_registry: bool = False
    gold_layout: str = "time"
    since: datetime | None = None
    clock: Callable[[], datetime] | None = None

    def __post_init__(self) -> None:
        for name, allowed in (
            ("token", ("fernet", "gcm")),
            ("bad_token", ("null", "raise")),
            ("lookback", ("history", "slice")),
            ("write", ("overwrite", "append")),
            ("consume", ("dates", "files")),
            ("late", ("leave", "recompute")),
            ("gold_layout", ("time", "instrument")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, got {getattr(self, name)!r}")
        if tuple(self.labels[: len(schemas.LABELS)]) != schemas.LABELS:
            raise ValueError(f"labels must start with {schemas.LABELS}, got {self.labels}")
        if self.compat:
            object.__setattr__(self, "lookback", "slice")
            object.__setattr__(self, "write", "append")
        if self.late == "recompute" and (self.write, self.lookback) != ("overwrite", "history"):
            raise ValueError("late='recompute' replaces whole days from all history: it needs write='overwrite' and lookback='history'")

    def table(self, layer: str, granularity: Granularity | None = None) -> str:
        return f"{self.root}/{layer}/{(granularity or self.granularity).name}"

    def stored_schema(self, layer: str) -> T.StructType:
        return {
            "bronze": schemas.BRONZE_STORED,
            "silver": schemas.silver(self.labels),
            "gold": schemas.gold(self.labels, self.granularity.gold_hourly),
        }[layer]

    def ledger(self, name: str) -> str:
        """A small table beside the layers: files read, days changed, how far layers have got, labels seen."""
        return f"{self.root}/_{name}"

    def text_log(self) -> str:
        """Root of the text log, which has a folder for each layer."""
        return f"{self.root}/_log_{self.granularity.name}"

    def run_log(self) -> str:
        return f"{self.root}/_run_log"
