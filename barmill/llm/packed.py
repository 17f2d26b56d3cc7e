"""Texts packed into blocks of bounded size, so that tasks count and look up a block's distinct keys instead of rows.

A block is one row of a stored table: the normalised bytes of its documents one after the other, compressed, and where
each ends. A text that is longer than a block goes through several; each but the first begins with some bytes of the one
before, which are context only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm.shingles import BYTES, PIECE, mixed, powers
from barmill.llm.util import arrow_map, slices, stored

#: Bytes of a block; one word that is longer stays whole.
BLOCK = 8 << 20
#: Bytes that numpy works on at a time.
CHUNK = 1 << 20
BLANK, END = 32, 10
#: Bits of a row's number for its place in its first block; a block has fewer documents, each takes a byte at least.
PLACE = 25

SCHEMA = "block long, data binary, size long, old long, rows array<long>, ids array<{kind}>, notes array<string>, ends array<long>"


@dataclass
class Block:
    """Bytes of a block, how many of them are context only, and its documents' rows, ids, notes and ends."""

    data: bytes
    old: int
    rows: list[int]
    ids: list
    notes: list
    ends: np.ndarray

    @classmethod
    def read(cls, table: pa.Table) -> Block:
        row = {c: table.column(c)[0] for c in ("data", "size", "old", "rows", "ids", "notes", "ends")}
        data = pa.decompress(row["data"].as_py(), row["size"].as_py(), codec="zstd", asbytes=True)
        ends = row["ends"].values.to_numpy(zero_copy_only=False)
        return cls(data, row["old"].as_py(), row["rows"].as_py(), row["ids"].as_py(), row["notes"].as_py(), ends)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])).astype(np.int64)


def pack(
    df: DataFrame, doc: Column, text: Column, note: Column, normal: Callable[[str], bytes],
    cut: Callable[[bytes, int], tuple[int, int]], size: int = BLOCK,
) -> DataFrame:
    """df's texts as a stored table of blocks; null texts are empty, and every row of df is a document.

    normal gives a text's bytes with one END last. cut(data, at) says where a long text is cut, at or after at, and from
    where on the next block repeats it as context.
    """
    rows = df.select(doc.alias("id"), F.coalesce(text, F.lit("")).alias("text"), note.cast("string").alias("note"))
    kind = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 20
        number, parts, old, held = 0, [], 0, ([], [], [], [])

        def closed() -> pa.RecordBatch:
            nonlocal number, parts, old, held
            data = b"".join(parts)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([first + number], pa.int64()), pa.array([pa.compress(data, codec="zstd", asbytes=True)], pa.binary()),
                    pa.array([len(data)], pa.int64()), pa.array([old], pa.int64()), pa.array([held[0]], pa.list_(pa.int64())),
                    pa.array([held[1]], pa.list_(ids.type)), pa.array([held[2]], pa.list_(pa.string())), pa.array([held[3]], pa.list_(pa.int64())),
                ],
                names=["block", "data", "size", "old", "rows", "ids", "notes", "ends"],
            )
            number, parts, old, held = number + 1, [], 0, ([], [], [], [])
            return out

        def put(row: int, doc, note, data: bytes) -> None:
            parts.append(data)
            for to, x in zip(held, (row, doc, note, (held[3][-1] if held[3] else 0) + len(data)), strict=True):
                to.append(x)

        for batch in slices(batches):
            ids = batch.column(0)
            for doc, text, note in zip(ids.to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = normal(text)
                if parts and held[3][-1] + len(data) > size:
                    yield closed()
                row = (first + number << PLACE) + len(held[0])
                while len(data) > size:
                    end, begin = cut(data, size + old)
                    if end >= len(data):
                        break
                    put(row, doc, note, data[:end])
                    yield closed()
                    data, old = data[begin:], end - begin
                put(row, doc, note, data)
        if parts:
            yield closed()

    return stored(arrow_map(rows, run, SCHEMA.format(kind=kind.simpleString())), "packed")


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words between BLANK and END bytes."""
    codes = np.frombuffer(data, np.uint8)
    word = np.concatenate(([False], (codes != BLANK) & (codes != END), [False]))
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # by pieces, so that the powers stay few
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        part = codes[low:high]
        up, down = powers(len(part))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(BYTES[part] * up[: len(part)])))
        s, e = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return starts, ends, hashes


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and their added counts."""
    every, n = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.int64), *counts])
    if not len(every):
        return every, n
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    return every[first], np.add.reduceat(n, first)


def emitted(block: int, names: tuple[str, ...], *columns: np.ndarray, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a block's number and columns, a bounded number of rows each."""
    for at in range(0, len(columns[0]), rows):
        part = [c[at : at + rows] for c in columns]
        part = [p.view(np.int64) if p.dtype == np.uint64 else p for p in part]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), block, np.int64)), *map(pa.array, part)], names=["block", *names])
