"""Collocations: phrases scored by how much oftener they occur than their parts would meet by chance.

Texts are cut into pieces, and phrases lie within one piece. A first pass over blocks of texts counts words and pairs by
their hashes. A phrase is frequent only if all pairs in it are, so a second pass reads from each block, with the frequent
words and pairs found there, the phrases made of them alone, as strings; those are counted again exactly.

The counts of frequent phrases are then kept as a stream in prefix order (by first word, second word and so on) and one in
suffix order (by last word backwards). In the one a phrase stands behind all its first parts and ahead of its extensions
to the right, in the other behind its last parts and ahead of those to the left; so both give the counts of parts and
extensions by running along in order, without hash tables, and both are merged phrase by phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.packed import BLANK, BLOCK, Block, emitted, pack, words
from barmill.llm.shingles import BASE, mixed
from barmill.llm.util import arrow_map, findable, stored

LONGEST, LEAST, MOST = 5, 100, 2000
UNKNOWN = "und"
#: Characters that end a piece, blanks between words, lower-cased letters.
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
FOLD = bytes(10 if b in ENDS else 32 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
NAMES = tuple(f"w{k}" for k in range(1, LONGEST + 1))


def normal(text: str) -> bytes:
    data = text.encode("utf-8", "surrogatepass").translate(FOLD)
    return b" ".join(filter(None, data.split(b" "))) + b"\n" if b"  " in data else data + b"\n"


def cut(data: bytes, at: int) -> tuple[int, int]:
    """A long text is cut where a word ends; the next block repeats the words that its first phrases may begin with."""
    blank = min((x for x in (data.find(b" ", at), data.find(b"\n", at)) if x >= 0), default=len(data) - 1)
    end = blank + 1
    begin = end
    for _ in range(LONGEST - 1):
        before = max(data.rfind(b" ", 0, max(begin - 1, 0)), data.rfind(b"\n", 0, max(begin - 1, 0)))
        begin = before + 1
        if begin == 0 or data[begin - 1] == 10:
            break
    return end, begin


class Words:
    """A block's words: where they stand, their hashes with their language's, and which pairs of neighbours are phrases."""

    def __init__(self, block: Block):
        self.block = block
        self.starts, self.ends, hashes = words(block.data)
        self.doc = np.searchsorted(block.ends, self.starts, "right")
        langs = np.array([_hash(n) for n in block.notes], np.uint64)
        self.hashes = mixed(hashes + langs[self.doc] * np.uint64(BASE))
        self.own = self.starts >= block.old
        codes = np.frombuffer(block.data, np.uint8)
        self.next = (self.starts[1:] == self.ends[:-1] + 1) & (codes[self.ends[:-1]] == BLANK)

    def phrases(self, size: int) -> np.ndarray:
        """A key for each run of size words, phrase or not."""
        key = np.full(max(len(self.hashes) - size + 1, 0), size, np.uint64)
        for j in range(size):
            key = mixed(key * np.uint64(BASE) + self.hashes[j : j + len(key)])
        return key

    def text(self, first: np.ndarray, size: int) -> pa.Array:
        """The phrases of size words that begin with these words."""
        low, high = self.starts[first], self.ends[first + size - 1]
        length = high - low
        offsets = np.concatenate(([0], np.cumsum(length)))
        at = np.repeat(low - offsets[:-1], length) + np.arange(offsets[-1])
        data = np.frombuffer(self.block.data, np.uint8)[at]
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _hash(text: str) -> int:
    total = 0
    for b in text.encode():
        total = int(mixed(np.array([total * 257 + b + 1 & (1 << 64) - 1], np.uint64))[0])
    return total


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and pairs of each block with their counts; pairs that are context only with count 0."""
    for number, block in _blocks(batches):
        found = Words(block)
        pairs, own = found.phrases(2)[found.next], found.own[1:][found.next]
        keys, n = np.unique(np.concatenate((found.phrases(1)[found.own], pairs[own])), return_counts=True)
        yield from emitted(number, ("key", "n"), keys, n.astype(np.int32))
        context = np.unique(pairs[~own])
        context = context[~_inside(context, keys)]
        yield from emitted(number, ("key", "n"), context, np.zeros(len(context), np.int32))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = pa.Table.from_batches([batch.slice(at, 1)])
            yield row.column("block")[0].as_py(), Block.read(row)


def _inside(keys: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    if not len(chosen):
        return np.zeros(len(keys), bool)
    return chosen[np.searchsorted(chosen, keys).clip(max=len(chosen) - 1)] == keys


def _read_phrases(left: pa.Table, right: pa.Table, longest: int) -> pa.Table:
    """lang, size, phrase and n of the phrases of one block that are made of frequent pairs; size 0: all its words."""
    found = Words(Block.read(left))
    chosen = np.sort(right.column("key").to_numpy().view(np.uint64))
    notes = np.array(found.block.notes, object)
    out = []
    langs, back = np.unique(notes.astype(str), return_inverse=True) if len(notes) else (notes, notes)
    total = np.bincount(back[found.doc[found.own]], minlength=len(langs)) if len(langs) else []
    out.append(pa.table([pa.array(langs.tolist(), pa.string()), pa.array([0] * len(langs), pa.int32()), pa.nulls(len(langs), pa.string()), pa.array(total, pa.int64())], names=["lang", "size", "phrase", "n"]))
    run = None
    for size in range(1, longest + 1):
        keys = found.phrases(size)
        if size == 1:
            there = _inside(keys, chosen)
        elif size == 2:
            there = pair = found.next & _inside(keys, chosen)
        else:
            there = run[:-1] & pair[size - 2 :]
        run = there
        at = np.flatnonzero(there & found.own[size - 1 :])
        if not len(at):
            continue
        _, first, n = np.unique(keys[at], return_index=True, return_counts=True)
        first = at[first]
        table = [pa.array(notes[found.doc[first]].tolist(), pa.string()), pa.array(np.full(len(first), size, np.int32)), found.text(first, size), pa.array(n.astype(np.int64))]
        out.append(pa.table(table, names=["lang", "size", "phrase", "n"]))
    return pa.concat_tables(out)


def counted(df: DataFrame, text_col: str, lang_col: str, longest: int, least: int, size: int = BLOCK) -> DataFrame:
    """lang, size, phrase, n of all phrases of 1 to longest words that occur least times or oftener; size 0: all words."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words, got {longest}")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    blocks = pack(df, F.lit(None).cast("long"), F.col(text_col).cast("string"), lang, normal, cut, size)
    by_block = arrow_map(blocks, _pair_counts, "block long, key long, n int")
    total = F.sum("n").over(Window.partitionBy("key"))
    frequent = by_block.withColumn("total", total).where(F.col("total") >= least).select("block", "key")
    findable(df.sparkSession)

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        return _read_phrases(left, right, longest)

    both = blocks.groupBy("block").cogroup(stored(frequent, "frequent").groupBy("block"))
    read = both.applyInArrow(read, "lang string, size int, phrase string, n long")
    found = read.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return stored(found.where((F.col("size") == 0) | (F.col("n") >= least)), "phrases")


def _along(rows: DataFrame, order: tuple[str, ...], parts: str, extension: str) -> DataFrame:
    """rows with the counts of their parts in this order, parts1 and so on, and the greatest one of a phrase a word longer."""
    ahead = rows.repartitionByRange("lang", order[0]).sortWithinPartitions("lang", *order)
    longer = F.lit(None).cast("long")
    for k in range(len(order), 0, -1):  # the longest first, so that one sort serves all
        behind = Window.partitionBy("lang", *order[:k])
        ahead = ahead.withColumn(f"{parts}{k}", F.max(F.when(F.col("size") == k, F.col("n"))).over(behind))
        ahead = ahead.withColumn(f"_{k}", F.max(F.when(F.col("size") == k + 1, F.col("n"))).over(behind))
        longer = F.when(F.col("size") == k, F.col(f"_{k}")).otherwise(longer)
    return ahead.withColumn(extension, longer).drop(*(f"_{k}" for k in range(1, len(order) + 1)))


def scored(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all candidates that no longer one of the same count holds."""
    order = NAMES[:longest]
    split = F.split("phrase", " ", -1)
    rows = phrases.where("size > 0").withColumns({w: F.get(split, F.lit(k)) for k, w in enumerate(order)})
    # Last words, from the end: b1 is the last.
    rows = rows.withColumns({f"b{k}": F.get(split, F.col("size") - k) for k in range(1, longest + 1)})
    forwards = _along(rows, order, "l", "right")
    both = _along(forwards, tuple(f"b{k}" for k in range(1, longest + 1)), "r", "left")
    kept = both.where((F.col("size") > 1) & ~(F.greatest("left", "right") >= F.col("n")).eqNullSafe(True))
    sizes = phrases.where("size = 0").select("lang", F.col("n").alias("words"))
    cuts = []
    for k in range(1, longest):
        right = F.expr(f"case size {' '.join(f'when {k + j} then r{j}' for j in range(1, longest - k + 1))} end")
        cuts.append(F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), right.alias("r"))))
    each = kept.join(sizes, "lang").select("lang", "phrase", F.col("n").alias("a"), F.col("words").alias("n"), F.array_compact(F.array(*cuts)).alias("cuts"))
    lowest = F.array_min(F.transform("cuts", lambda c: F.struct(_score(c), c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r"))))
    return each.withColumn("cut", lowest).select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def _score(c: Column) -> Column:
    """floor(1000 * a * n / (l * r)) of a cut, in decimals of 38 digits."""
    whole = "decimal(19,0)"
    above = (1000 * F.col("a")).cast(whole) * F.col("n").cast(whole)
    below = c["l"].cast(whole) * c["r"].cast(whole)
    return F.call_function("div", above, below).alias("score")


def mine(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST,
    most: int = MOST, size: int = BLOCK,
) -> DataFrame:
    """The first most collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A null lang is und, a null text is empty; repeated rows count each time; equal scores go by count, then by the
    phrase's bytes. An empty table, or one without a frequent phrase, gives an empty result; other columns of df are
    not looked at.
    """
    best = scored(counted(df.select(text_col, lang_col), text_col, lang_col, longest, least, size), longest)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return best.withColumn("rank", rank).where(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
