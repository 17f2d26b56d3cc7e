"""Exact token counts by overlapping chunks.

Texts are encoded in chunks that overlap. Each chunk yields the places where a split of the tokenizer starts. A split
only looks ahead, never back, so from a place that both chunks know as a start, the right chunk's splits are those of
the whole text; the left chunk's are, up to the place where its end could change a choice. The two are spliced at
the first such common place. If an overlap has none, as inside one very long word, the overlap is widened.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.bpe import REACH, WORDS, ByteBpe, load
from barmill.llm.util import arrow_map, slices

CHUNK = 1 << 15
OVERLAP = 1 << 9


class Counter:
    """Counts tokens with the counts of frequent words kept."""

    def __init__(self, bpe: ByteBpe, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.bpe, self.chunk, self.overlap = bpe, chunk, overlap
        self.known: dict[str, int] = {}
        self.widened = 0

    def of_word(self, word: str) -> int:
        if len(self.known) >= WORDS:
            self.known.clear()
        self.known[word] = n = len(self.bpe.merge(word.encode("utf-8", "surrogatepass")))
        return n

    def plain(self, text: str) -> int:
        """Tokens of a text that is one chunk and holds no special token."""
        get, own = self.known.get, self.of_word
        return sum([get(w) or own(w) for w in self.bpe.pattern.findall(text)])

    def encoded(self, text: str, start: int, end: int) -> tuple[list[int], list[int]]:
        """Where the splits of one chunk start, in the whole text, and how many tokens each has."""
        places, counts, at = [], [], start
        specials = self.bpe.special.finditer(text, start, end) if self.bpe.special else ()
        for low, high, one in [*((m.start(), m.end(), 1) for m in specials), (end, end, 0)]:
            part = text[at:low]  # a special token ends the text before it, also for the look ahead of a split
            for m in self.bpe.pattern.finditer(part):
                places.append(at + m.start())
                counts.append(self.known.get(m[0]) or self.of_word(m[0]))
            if one:
                places.append(low)
                counts.append(1)
            at = high
        return places, counts

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            if not self.bpe.special or not self.bpe.special.search(text):
                return self.plain(text)
            return sum(self.encoded(text, 0, len(text))[1])
        total, overlap = 0, self.overlap
        start, end = 0, self.chunk
        places, counts = self.encoded(text, start, end)
        first = 0  # the first split of this chunk that is not counted yet
        while end < len(text):
            margin = REACH + max(map(len, self.bpe.specials), default=0)
            begin = max(end - overlap, start + 1)
            until = min(begin + self.chunk, len(text))
            following = self.encoded(text, begin, until)
            stable = self.last_stable(text, places, end, margin)
            common = self.splice(places, first, stable, following[0])
            if common is None:  # no proven common place: widen, to the left while there is room, then to the right
                self.widened += 1
                if begin > start + 1 and (first >= len(places) or begin > places[first]):
                    overlap *= 2
                else:
                    end = min(end + overlap, len(text))
                    overlap *= 2
                    places, counts = self.encoded(text, start, end)
                    first = 0 if total == 0 else bisect_left(places, self.done)
                continue
            left, right = common
            total += sum(counts[first:left])
            self.done = following[0][right]
            places, counts, first = *following, right
            start, end, overlap = begin, until, self.overlap
        return total + sum(counts[first:])

    @staticmethod
    def last_stable(text: str, places: list[int], end: int, margin: int) -> int:
        """How many starts no longer hang on text after end: the split under way at the margin may still change."""
        return max(bisect_left(places, end - margin) - 1, 0)

    @staticmethod
    def splice(left: list[int], first: int, stable: int, right: list[int]) -> tuple[int, int] | None:
        """Indexes of a place in both chunks, past what is counted; the last of them, so that it has most context."""
        for k in range(min(stable, len(left) - 1), first, -1):
            if not right or left[k] < right[0]:
                return None
            j = bisect_left(right, left[k])
            if j < len(right) and right[j] == left[k]:
                return k, j
        return None


def count_tokens(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    A null text counts as the empty one, which has no token. A null doc_id and repeated rows stay as they are; an
    empty table gives an empty result; other columns of df are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load(path), chunk, overlap)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            size = [len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = arrow_map(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
