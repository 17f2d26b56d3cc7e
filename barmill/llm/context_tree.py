"""Probability of texts by context-tree weighting over bytes.

A text is its lower-cased words, one blank between two, and one end. A byte is eight binary choices. Each choice has a
node for every context of 0 to DEPTH bytes; a node holds how often the choice was 0 and 1 in training texts, hence a
Krichevsky-Trofimov estimate, and the weight of stopping there rather than going on to longer contexts, hence the mixture
of all depths. Counts at every depth follow from those of the distinct grams of DEPTH + 1 bytes.

Grams are counted by blocks and then over the corpus, also those of held-out texts, with count 0. What lies below a
context of TOP bytes is worked out where its grams are sorted together: at most 256 ** (DEPTH + 1 - TOP) grams whatever
the corpus. Above it there are fewer than 2 ** 16 nodes, which go to the driver and back. Grams get their probability,
blocks look up those of their own grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from barmill.llm.packed import CHUNK, END, Block, emitted, merged, pack, words
from barmill.llm.util import arrow_map, findable, stored

#: Bytes of the longest context, and of the contexts that are not split among tasks.
DEPTH, TOP = 4, 2
HALF = np.log(0.5)
#: Bytes of a block.
BLOCK = 16 << 20
#: Grams that a task works out at a time, but for one context of TOP bytes.
GRAMS = 1 << 18
#: Bytes between words, lower-cased letters.
FOLD = bytes(32 if b in b"\x20\x09\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def normal(text: str) -> bytes:
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(FOLD).split()) + b"\n"


def cut(data: bytes, at: int) -> tuple[int, int]:
    """A long text is cut after a blank; the next block sees DEPTH bytes before the cut."""
    end = data.find(b" ", at - 1) + 1 or len(data)
    return end, end - DEPTH


def packed(df: DataFrame, id_col: str, text_col: str, rest: int, size: int = BLOCK) -> DataFrame:
    """Blocks whose documents are noted as held out ('1') or learned from ('0'); a null id is learned from."""
    return pack(df, F.col(id_col), F.col(text_col).cast("string"), held_out(id_col, rest).cast("int"), normal, cut, size)


def held_out(id_col: str, rest: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == rest, F.lit(False))


def grams(codes: np.ndarray, low: int, high: int, begins: np.ndarray) -> np.ndarray:
    """Keys of the grams that end at low to high: the context's bytes, the nearest one highest, then the byte itself.

    begins: where the text of each of these bytes starts. Before a text stand END bytes.
    """
    at = np.arange(low, high)
    into = at - begins
    out = codes[low:high].astype(np.uint64)
    for j in range(1, DEPTH + 1):
        near = np.where(into >= j, codes[np.maximum(at - j, 0)], END).astype(np.uint64)
        out |= near << np.uint64(8 * (DEPTH + 1 - j))
    return out


def _chunks(block: Block) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of a block's own bytes: from, to, the document of each byte and where its text starts."""
    begins = block.starts
    if block.old:
        begins[0] = -DEPTH  # a text that goes on: what stands before is its own
    for low in range(block.old, len(block.data), CHUNK):
        high = min(low + CHUNK, len(block.data))
        doc = np.searchsorted(block.ends, np.arange(low, high), "right")
        yield low, high, doc, begins[doc]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, block in _blocks(batches):
        codes = np.frombuffer(block.data, np.uint8)
        learned = np.array([n == "0" for n in block.notes])
        keys, counts = [], []
        for low, high, doc, begins in _chunks(block):
            found = (grams(codes, low, high, begins) << np.uint64(1)) | learned[doc].astype(np.uint64)
            k, n = np.unique(found, return_counts=True)
            k, n = merged([k >> np.uint64(1)], [n * (k & np.uint64(1)).astype(np.int64)])
            keys, counts = [*keys, k], [*counts, n]
        yield from emitted(number, ("key", "n"), *merged(keys, counts))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, block in _blocks(batches):
        starts, _, hashes = words(block.data)
        own = starts >= block.old
        learned = np.array([n == "0" for n in block.notes])[np.searchsorted(block.ends, starts[own], "right")]
        keys, n = merged([hashes[own]], [learned.astype(np.int64)])
        yield from emitted(number, ("key", "n"), keys, n)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = pa.Table.from_batches([batch.slice(at, 1)])
            yield row.column("block")[0].as_py(), Block.read(row)


def log_gamma(z: np.ndarray) -> np.ndarray:
    """By Stirling's series eight places up."""
    y, shift = z + 8, np.ones_like(z)
    for k in range(8):
        shift = shift * (z + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


class Tree:
    """Nodes below contexts of TOP bytes, all of whose grams are given: keys ascending and distinct, and their counts.

    For each depth and bit: nodes in order of their keys, with counts and the log of the weighted probability of all that
    was seen there; parent: the node of the same choice one byte of context less.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.rows, self.up = {DEPTH: (keys, n.astype(np.float64))}, {}
        for d in range(DEPTH - 1, TOP - 1, -1):
            k, count = self.rows[d + 1]
            k, back = np.unique(((k >> np.uint64(16)) << np.uint64(8)) | (k & np.uint64(255)), return_inverse=True)
            self.rows[d], self.up[d + 1] = (k, np.bincount(back, count, len(k))), back
        self.node, self.first, self.zeros, self.ones, self.stop, self.weighted = {}, {}, {}, {}, {}, {}
        for d in range(DEPTH, TOP - 1, -1):
            k, count = self.rows[d]
            for bit in range(8):
                prefix = k >> np.uint64(8 - bit)
                new = np.concatenate(([True], prefix[1:] != prefix[:-1]))
                first = np.flatnonzero(new)
                set_ = ((k >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.float64)
                at = (d, bit)
                self.node[at], self.first[at] = np.cumsum(new) - 1, first
                self.ones[at] = np.add.reduceat(count * set_, first)
                self.zeros[at] = np.add.reduceat(count, first) - self.ones[at]
                here = log_kt(self.zeros[at], self.ones[at])
                if d == DEPTH:
                    self.stop[at], self.weighted[at] = np.ones_like(here), here
                else:
                    below = np.bincount(self.parent(d + 1, bit), self.weighted[d + 1, bit], len(first))
                    self.weighted[at] = np.logaddexp(HALF + here, HALF + below)
                    self.stop[at] = np.exp(HALF + here - self.weighted[at])

    def parent(self, d: int, bit: int) -> np.ndarray:
        return self.node[d - 1, bit][self.up[d][self.first[d, bit]]]

    def top(self) -> tuple[np.ndarray, ...]:
        """Of the nodes at depth TOP: the last byte of their context, the choice, zeros, ones and weighted."""
        out = []
        for bit in range(8):
            k = self.rows[TOP][0][self.first[TOP, bit]]
            choice = (1 << bit) | ((k & np.uint64(255)) >> np.uint64(8 - bit))
            out.append((k >> np.uint64(8 * TOP), choice, self.zeros[TOP, bit], self.ones[TOP, bit], self.weighted[TOP, bit]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def log_probability(self, chances: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each gram's byte; chances and rest come from the nodes above (see mixed_down)."""
        total = np.zeros(len(self.rows[DEPTH][0]))
        for bit in range(8):
            k = self.rows[TOP][0][self.first[TOP, bit]]
            last, choice = (k >> np.uint64(8 * TOP)).astype(np.int64), ((1 << bit) | ((k & np.uint64(255)) >> np.uint64(8 - bit))).astype(np.int64)
            zero, one, left = chances[0, last, choice], chances[1, last, choice], rest[last, choice]
            for d in range(TOP, DEPTH + 1):
                if d > TOP:
                    up = self.parent(d, bit)
                    zero, one, left = zero[up], one[up], left[up]
                a, b, stop = self.zeros[d, bit], self.ones[d, bit], self.stop[d, bit]
                zero, one, left = zero + left * stop * (a + 0.5) / (a + b + 1), one + left * stop * (b + 0.5) / (a + b + 1), left * (1 - stop)
            set_ = ((self.rows[DEPTH][0] >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
            at = self.node[DEPTH, bit]
            total += np.log(np.where(set_, one[at], zero[at]))
        return total


def mixed_down(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the contexts of 0 and 1 bytes give: the mixed chances of 0 and 1, and the weight left for longer contexts.

    zeros, ones and below (the sum of the next depth's logs) are by last byte and choice.
    """
    here = log_kt(zeros, ones)
    weighted = np.logaddexp(HALF + here, HALF + below)
    stop = np.exp(HALF + here - weighted)
    a, b = zeros.sum(0), ones.sum(0)
    root = log_kt(a, b)
    stop_root = np.exp(HALF + root - np.logaddexp(HALF + root, HALF + weighted.sum(0)))
    left = 1 - stop_root
    zero = stop_root * (a + 0.5) / (a + b + 1) + left * stop * (zeros + 0.5) / (zeros + ones + 1)
    one = stop_root * (b + 0.5) / (a + b + 1) + left * stop * (ones + 0.5) / (zeros + ones + 1)
    return np.stack([zero, one]), left * (1 - stop)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
    """Trees of whole contexts of TOP bytes, of GRAMS grams at a time or so."""
    keys, counts, size, enough = [], [], 0, GRAMS
    for batch in batches:
        keys.append(batch.column(0).to_numpy().view(np.uint64))
        counts.append(batch.column(1).to_numpy())
        size += batch.num_rows
        if size >= enough:
            every, n = np.concatenate(keys), np.concatenate(counts)
            context = every >> np.uint64(8 * (DEPTH + 1 - TOP))
            whole = int(np.searchsorted(context, context[-1]))
            if whole:
                yield Tree(every[:whole], n[:whole])
            keys, counts, size = [every[whole:]], [n[whole:]], len(every) - whole
            enough = max(GRAMS, 2 * size)  # one large context is gathered without copying it over and over
    if size:
        yield Tree(np.concatenate(keys), np.concatenate(counts))


def learned(counts: DataFrame) -> DataFrame:
    """key and value, the log of the probability, of every gram of counts (key, n)."""
    shift = 8 * (DEPTH + 1 - TOP)
    ordered = counts.repartition(F.shiftright("key", shift)).sortWithinPartitions("key")

    def upward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees(batches):
            last, choice, zeros, ones, weighted = tree.top()
            kinds = (last.astype(np.int64), choice.astype(np.int64), zeros, ones, weighted)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in kinds], names=["last", "choice", "zeros", "ones", "below"])

    above = arrow_map(ordered, upward, "last long, choice long, zeros double, ones double, below double")
    table = np.zeros((3, 256, 256))
    names = ("zeros", "ones", "below")
    for r in above.groupBy("last", "choice").agg(*(F.sum(c).alias(c) for c in names)).collect():  # 256 * 255 rows at most
        table[:, r["last"], r["choice"]] = [r[c] for c in names]
    chances, rest = mixed_down(*table)

    def downward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees(batches):
            value = tree.log_probability(chances, rest)
            yield pa.RecordBatch.from_arrays([pa.array(tree.rows[DEPTH][0].view(np.int64)), pa.array(value)], names=["key", "value"])

    return arrow_map(ordered, downward, "key long, value double")


def _scored(kind: pa.DataType):
    """Sums of each document's share of a block; right: the block's words (kind 1) and grams (kind 0) with their values."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.read(left)
        is_word = right.column("kind").to_numpy() == 1
        keys, values = right.column("key").to_numpy().view(np.uint64), right.column("value").to_numpy()
        found = []
        for chosen in (is_word, ~is_word):
            order = np.argsort(keys[chosen])
            found.append((keys[chosen][order], values[chosen][order]))
        (word_keys, word_values), (gram_keys, gram_values) = found
        n, codes = len(block.ends), np.frombuffer(block.data, np.uint8)
        score = np.zeros(n)
        for low, high, doc, begins in _chunks(block):
            value = gram_values[np.searchsorted(gram_keys, grams(codes, low, high, begins))]
            score += np.bincount(doc, value, n)
        starts, _, hashes = words(block.data)
        own = starts >= block.old
        doc = np.searchsorted(block.ends, starts[own], "right")
        count = word_values[np.searchsorted(word_keys, hashes[own])] if own.any() else np.empty(0)
        columns = (
            pa.array(block.rows, pa.int64()), pa.array(block.ids, kind), pa.array([x == "1" for x in block.notes]),
            pa.array(np.bincount(doc, minlength=n)), pa.array(np.bincount(doc[count > 0], minlength=n)),
            pa.array(np.bincount(doc, np.log10(count + 1), n).astype(np.float64)), pa.array(score),
        )
        return pa.table(list(columns), names=["row", "doc_id", "held_out", "n_words", "known", "seen", "score"])

    return run


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rest: int = 2, size: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of df.

    score is the log10 probability of the text's words, blanks and end under the context trees, base_score that of its
    words and end under single words' counts plus one. A null text counts as the empty one, which has its end only. A
    null doc_id is learned from, as is a repeated row each time. With nothing to learn from, N and V are 0 and every
    byte's probability is 2 ** -8. An empty table gives an empty result; other columns of df are not looked at. Words
    are told apart by 64-bit hashes.
    """
    blocks = packed(df.select(id_col, text_col), id_col, text_col, rest, size)
    by_gram = stored(arrow_map(blocks, _gram_counts, "block long, key long, n long"), "grams")
    model = learned(by_gram.groupBy("key").agg(F.sum("n").alias("n")))
    by_word = arrow_map(blocks, _word_counts, "block long, key long, n long")
    whole = Window.partitionBy("key")
    known = stored(by_word.select("block", "key", F.sum("n").over(whole).alias("c"), F.row_number().over(whole.orderBy("block")).alias("place"), "n"), "words")
    looked_up = known.select("block", F.lit(1).alias("kind"), "key", F.col("c").cast("double").alias("value")).union(
        by_gram.join(model, "key").select("block", F.lit(0).alias("kind"), "key", "value")
    )
    findable(df.sparkSession)
    kind = blocks.schema["ids"].dataType.elementType
    parts = blocks.groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(
        _scored(to_arrow_type(kind)),
        f"row long, doc_id {kind.simpleString()}, held_out boolean, n_words long, known long, seen double, score double",
    )
    texts = parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        *(F.sum(c).alias(c) for c in ("n_words", "known", "seen", "score")), F.count("*").alias("parts"),
    )
    ends = df.agg(F.count_if(~held_out(id_col, rest)).alias("ends")).select("ends", F.lit(1).alias("one"))
    zero = F.lit(0).cast("long")
    sizes = known.agg(F.coalesce(F.sum("n"), zero).alias("n"), F.count_if(F.expr("place = 1 and c > 0")).alias("v")).select("n", "v", F.lit(1).alias("one"))
    sizes = sizes.join(ends, "one").select("one", "ends", (F.col("n") + F.col("ends")).alias("n"), (F.col("v") + (F.col("ends") > 0).cast("long")).alias("v"))
    n_tokens = F.col("n_words") + 1
    return texts.withColumn("one", F.lit(1)).join(F.broadcast(sizes), "one").select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("known") + (F.col("ends") > 0).cast("long")).alias("n_known"),
        F.col("n").alias("train_tokens"),
        (F.col("seen") + F.log10(F.col("ends") + 1) - n_tokens * F.log10(F.col("n") + F.col("v") + 1)).alias("base_score"),
        (F.col("score") / np.log(10)).alias("score"),
    )
