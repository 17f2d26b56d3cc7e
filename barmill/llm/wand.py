"""Exact BM25 top-k search: an inverted index in segments, searched with block-max WAND pruning.

A segment holds postings of a few thousand documents, ordered so that documents with the same commonest term and of
like length are neighbours, and cut into blocks. For each term and block the index knows the largest impact. A query
adds these maxima up to a bound for each block, opens the blocks of the highest bounds, and then all whose bound is not
below the k-th score found. Term statistics are global, so the scores of all segments compare, and merging their k best
is exact.

Queries of like words are searched together. Words that many of them share are weighed by products of matrices, first
with the maxima of all blocks, then with the documents of open ones; of the other words, which are in few documents, all
postings are added. These sums have single precision and bound the scores from both sides; documents that may be among the
k best are scored again in double precision, word by word.

Segments are searched in levels, each SEED times as many as the one before; the k-th scores found so far start the
search of a level, which then opens fewer blocks and returns few rows.

How many documents hold a term is counted once. Queries go in waves of a bounded number of terms; a wave is broadcast to
the segments, which stay where they are stored, and its results are stored before the next one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.shingles import words
from barmill.llm.util import arrow_map, stored

K1, B = 1.2, 0.75
K = 10
#: Documents and words of a segment, documents of a block, and terms of all queries of a wave, at most about.
SEGMENT, SEGMENT_WORDS, BLOCK, WAVE = 8192, 4_000_000, 32, 2_000_000
#: A level has so many times the segments of the one before; segments are dealt to levels by a draw below DRAWS.
SEED, DRAWS = 8, 1 << 30
#: Queries that are searched together, and their terms, at most; the commonest terms by which they are told to be alike.
TOGETHER, TERMS, ALIKE = 256, 1 << 18, 512
#: One posting that is added costs about as much as so many entries of a matrix.
RATE = 400
#: Terms of a matrix at most, entries of one at a time, postings of a row, and rows that are added at a time, at about.
COLUMNS, ENTRIES, ROW, ROWS = 4096, 1 << 22, 8, 4096


def _bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(words(text or ""), return_counts=True)


def _narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 on in the fewest bytes that hold the largest; _wide reads them, knowing how many they are."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(data: pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}" if n else np.uint8)


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """A row for each segment: ids, lens, and postings by term (terms, dfs, docs, tfs as packed numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        bags: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def packed() -> pa.RecordBatch:
            lens = np.array([c.sum() for _, c in bags], np.int64)
            top = np.array([t[c.argmax()] if len(t) else 0 for t, c in bags], np.uint64)
            order = np.lexsort((lens, top))
            terms = np.concatenate([bags[d][0] for d in order]).astype(np.uint64)
            tfs = np.concatenate([bags[d][1] for d in order]).astype(np.int32)
            docs = np.repeat(np.arange(len(order), dtype=np.int32), [len(bags[d][0]) for d in order])
            by = np.argsort(terms, kind="stable")
            unique, dfs = np.unique(terms, return_counts=True)
            values = [
                pa.array([[ids[d] for d in order]], pa.list_(pa.int64())), pa.array([lens[order].astype(np.int32).tobytes()], pa.binary()),
                pa.array([int(lens.sum())], pa.int64()), pa.array([len(order)], pa.int64()),
                *(pa.array([v], pa.binary()) for v in (unique.tobytes(), _narrow(dfs), _narrow(docs[by]), _narrow(tfs[by]))),
            ]
            return pa.RecordBatch.from_arrays(values, names=["ids", "lens", "n_words", "n_docs", "terms", "dfs", "docs", "tfs"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                bags.append(_bag(text.as_py()))
                size += int(bags[-1][1].sum())
                if len(ids) >= segment or size >= SEGMENT_WORDS:
                    yield packed()
                    ids, bags, size = [], [], 0
        if ids:
            yield packed()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "ids array<long>, lens binary, n_words long, n_docs long, terms binary, dfs binary, docs binary, tfs binary"
    index = arrow_map(rows, run, schema).withColumn("draw", F.pmod(F.xxhash64("ids"), F.lit(DRAWS)))
    return stored(index, "segments")


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at starts."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Searcher:
    """One segment with block maxima of the terms of a wave."""

    def __init__(self, vocabulary: np.ndarray, mean: float, ids: np.ndarray, lens, terms, dfs, docs, tfs, block: int = BLOCK):
        at = np.searchsorted(vocabulary, terms).clip(max=len(vocabulary) - 1)
        wanted = vocabulary[at] == terms
        dfs = dfs.astype(np.int64)
        chosen = _ranges((np.cumsum(dfs) - dfs)[wanted], dfs[wanted])
        docs, tfs = docs[chosen].astype(np.int32), tfs[chosen]
        del chosen
        self.ids, self.block = ids, block
        self.impact = tfs * (K1 + 1) / (tfs + (K1 * (1 - B + B * lens / mean))[docs])
        self.docs = docs
        self.n_blocks = -(-len(lens) // block)
        self.df = dfs[wanted]
        self.start = np.cumsum(self.df) - self.df
        #: The number that a term of the vocabulary has here, -1 if the segment lacks it.
        self.local = np.full(len(vocabulary), -1, np.int32)
        self.local[at[wanted]] = np.arange(len(self.df))
        #: Postings in rows of one term; places left over have no impact, on a block of their own.
        self.rows = -(-self.df // ROW)
        self.row = np.cumsum(self.rows) - self.rows
        to = np.arange(len(docs), dtype=np.int32)
        to += np.repeat((self.row * ROW - self.start).astype(np.int32), self.df)
        row_docs = np.full(self.rows.sum() * ROW, self.n_blocks * block, np.int32)
        row_impact = np.zeros(len(row_docs), np.float32)
        row_docs[to], row_impact[to] = docs, self.impact
        self.row_docs, self.row_impact = row_docs.reshape(-1, ROW), row_impact.reshape(-1, ROW)
        del to
        #: Postings by document, in order of their terms.
        by = np.argsort(docs.astype(np.uint16) if len(lens) <= 1 << 16 else docs, kind="stable")
        self.doc_terms = np.repeat(np.arange(len(self.df), dtype=np.int32), self.df)[by]
        self.doc_impact = self.impact[by]
        self.held = np.bincount(docs, minlength=len(lens))
        self.first = np.cumsum(self.held) - self.held
        self.opened = 0

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, known: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents, by score and then id (null last), none below a known k-th score."""
        _, found, scores = self.search_all(np.array([len(terms)]), terms, weights, k, np.array([known]))
        return found, scores

    def search_all(self, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, ...]:
        """The numbers of queries, places and scores of what search finds for each of several queries, whose terms lie end to end."""
        local = self.local[terms]
        here = local >= 0
        query, term, weight = np.repeat(np.arange(len(sizes)), sizes)[here], local[here], weights[here]
        near, place = self._near(query, term, weight, len(sizes), k, known)
        edges, own = np.searchsorted(near, np.arange(len(sizes) + 1)), np.searchsorted(query, np.arange(len(sizes) + 1))
        weighed = np.zeros(len(self.df))
        found, scores, counts = [np.empty(0, np.int64)], [np.empty(0)], np.zeros(len(sizes), np.int64)
        for q in np.flatnonzero(np.diff(edges)):
            docs, mine = place[edges[q] : edges[q + 1]], slice(own[q], own[q + 1])
            weighed[term[mine]] = weight[mine]
            lengths = self.held[docs]
            postings = _ranges(self.first[docs], lengths)
            each = weighed[self.doc_terms[postings]] * self.doc_impact[postings]
            got = np.bincount(np.repeat(np.arange(len(docs)), lengths), each, len(docs))
            weighed[term[mine]] = 0
            enough = got >= max(known[q], 1e-300)
            docs, got = docs[enough], got[enough]
            best = np.lexsort((self.ids[docs], -got))[:k]
            found.append(docs[best])
            scores.append(got[best])
            counts[q] = len(best)
        return np.repeat(np.arange(len(sizes)), counts), np.concatenate(found), np.concatenate(scores)

    def _near(self, query, term, weight, n: int, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries, in order, and places of documents that may be among the k best of them and reach the known scores."""
        block, n_blocks = self.block, self.n_blocks
        #: Twice the rounding of a sum of products in single precision, in parts of it.
        slack = 1 + (np.bincount(query, minlength=n) + 8) * 2.0**-23
        asks = np.bincount(term, minlength=len(self.df))
        worth = (asks - 1) * self.df
        columns = np.flatnonzero(worth > n * len(self.ids) / RATE)
        if len(columns) > COLUMNS:
            columns = np.sort(columns[np.argpartition(-worth[columns], COLUMNS)[:COLUMNS]])
        column = np.full(len(self.df), -1)
        column[columns] = np.arange(len(columns))
        column = column[term]
        shared = column >= 0
        wanted = np.zeros((n, len(columns)), np.float32)
        wanted[query[shared], column[shared]] = weight[shared]
        postings = _ranges(self.start[columns], self.df[columns])
        by = np.repeat(np.arange(len(columns)), self.df[columns])
        impact = self.impact[postings].astype(np.float32)
        at, within = np.divmod(self.docs[postings], np.int32(block))
        most = np.zeros((len(columns), n_blocks), np.float32)
        if len(postings):
            new = np.flatnonzero(np.concatenate(([True], (by[1:] != by[:-1]) | (at[1:] != at[:-1]))))
            most[by[new], at[new]] = np.maximum.reduceat(impact, new)
        rest = self._added(query[~shared], term[~shared], weight[~shared], n)
        bound = (wanted @ most + rest.max(2)) * slack[:, None]
        least = np.array(known, float)
        unopened = np.ones(n_blocks, bool)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]

        def open_blocks(now: np.ndarray) -> None:
            unopened[now] = False
            self.opened += len(now)
            step = max(1, ENTRIES // max(len(columns), n) // block)
            for low in range(0, len(now), step):
                some = now[low : low + step]
                sums = rest[:, some].reshape(n, -1)
                if len(columns):
                    moved = np.full(n_blocks, -1)
                    moved[some] = np.arange(len(some)) * block
                    to = moved[at]
                    inside = to >= 0
                    docs = np.zeros((len(columns), len(some) * block), np.float32)
                    docs[by[inside], to[inside] + within[inside]] = impact[inside]
                    sums += wanted @ docs
                if (unknown := np.flatnonzero(least <= 0)).size and sums.shape[1] >= k:
                    least[unknown] = np.partition(sums[unknown], -k, axis=1)[:, -k] / slack[unknown]
                enough = np.maximum(least / slack * (1 - 2.0**-22), 1e-38).astype(np.float32)
                q, doc = np.nonzero(sums >= enough[:, None])
                found.append((q, some[doc // block] * block + doc % block, sums[q, doc]))

        if (least <= 0).any():
            step = min(max(4, 2 * k // block + 1), n_blocks)
            best = np.zeros(n_blocks, bool)
            best[np.argpartition(-bound[least <= 0], step - 1, axis=1)[:, :step]] = True
            open_blocks(np.flatnonzero(best))
        open_blocks(np.flatnonzero(((bound >= least[:, None]) & (bound > 0)).any(0) & unopened))
        query, place, sums = (np.concatenate(part) for part in zip(*found))
        chosen = np.flatnonzero(sums * slack[query] * (1 + 2.0**-22) >= least[query])
        chosen = chosen[np.argsort(query[chosen], kind="stable")]
        return query[chosen], place[chosen]

    def _added(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """The sums of all postings of the terms, by query, block and document of it."""
        wide = (self.n_blocks + 1) * self.block
        sums = np.zeros((n, wide), np.float32)
        rows = self.rows[term]
        ends = np.concatenate(([0], np.cumsum(rows)))
        first = np.searchsorted(query, np.arange(n + 1))
        upto = ends[first]
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(upto, upto[low] + ROWS, side="right")) - 1)
            part = slice(first[low], first[high])
            if total := upto[high] - upto[low]:
                row = np.arange(total)
                row += np.repeat(self.row[term[part]] - (ends[part.start : part.stop] - upto[low]), rows[part])
                key = self.row_docs.take(row, axis=0) + np.repeat((query[part] - low) * wide, rows[part])[:, None]
                value = self.row_impact.take(row, axis=0) * np.repeat(weight[part], rows[part])[:, None]
                sums[low:high] = np.bincount(key.ravel(), value.ravel(), (high - low) * wide).reshape(high - low, wide)
            low = high
        return sums.reshape(n, self.n_blocks + 1, self.block)[:, :-1]


def _alike(weights: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Queries (rows of weights) in parts of at most TOGETHER queries, and about TERMS terms, cut across the widest spread."""
    done, left = [], [np.arange(len(weights))]
    while left:
        part = left.pop()
        if len(part) <= TOGETHER and (sizes[part].sum() <= TERMS or len(part) == 1):
            done.append(part)
            continue
        spread = weights[part] - weights[part].mean(0)
        way = spread[(spread * spread).sum(1).argmax()]
        for _ in range(8):
            way = spread.T @ (spread @ way)
            way /= max(float(np.sqrt(way @ way)), 1e-30)
        part = part[np.argsort(spread @ way, kind="stable")]
        half = TOGETHER * -(-len(part) // (2 * TOGETHER)) if len(part) > TOGETHER else -(-len(part) // 2)
        left += [part[half:], part[:half]]
    return done


LAST = np.iinfo(np.int64).max


def search(index: DataFrame, queries: DataFrame, k: int = K, wave: int = WAVE) -> DataFrame:
    """query_id, rank, doc_id and score of the k best documents of each query (query_id, text).

    Every word of a query counts as often as it stands there. Documents without any word of the query do not
    match; of equal scores the lower doc_id is first, and null ids come last. Queries without words, and an empty
    index, give no row. Of several queries with one id, the least text counts; queries with a null id are left out.
    """
    spark = index.sparkSession
    totals = index.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("words"), F.count("*").alias("segments")).first()
    n, mean = totals["n"] or 0, (totals["words"] or 0) / max(totals["n"] or 0, 1)
    levels = [(0, DRAWS)]
    while SEED ** len(levels) <= max(totals["segments"], SEED):  # the first level has a few segments at any size
        low, high = levels.pop(0)
        levels[:0] = [(0, high // SEED), (high // SEED, high)]
    schema = "query_id long, doc_id long, score double"

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms, counts = _bag(text.as_py())
                if len(terms):
                    values = [[query_id], [len(terms)], [terms.tobytes()], [counts.astype(np.int32).tobytes()]]
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names=["query_id", "m", "terms", "counts"])

    asked = queries.where("query_id is not null").groupBy("query_id").agg(F.min("text").alias("text"))
    asked = stored(arrow_map(asked, bags, "query_id long, m long, terms binary, counts binary"), "queries")
    waves = -(-int(asked.agg(F.sum("m")).first()[0] or 0) // wave)
    found = [spark.createDataFrame([], schema)]
    dfs = stored(document_frequencies(index), "frequencies") if waves else None
    for number in range(waves):
        own = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(waves)) == number).orderBy("query_id").toArrow()
        if own.num_rows:
            found.append(_wave(index, levels, dfs, own, n, mean, k, schema))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def document_frequencies(index: DataFrame) -> DataFrame:
    """term and df, the documents that hold it, over all segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, d in zip(batch.column(0), batch.column(1)):
                t = np.frombuffer(t.as_buffer(), np.int64)
                d = _wide(d.as_buffer(), len(t))
                for low in range(0, len(t), 1 << 16):
                    part = slice(low, low + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(t[part]), pa.array(d[part].astype(np.int64))], names=["term", "df"])

    counts = arrow_map(index.select("terms", "dfs"), run, "term long, df long")
    return counts.groupBy("term").agg(F.sum("df").alias("df"))


def _wave(index: DataFrame, levels: list[tuple[int, int]], dfs: DataFrame, own: pa.Table, n: int, mean: float, k: int, schema: str) -> DataFrame:
    """The k best of every segment for the queries of one wave; what is broadcast is bounded by WAVE, and let go after it."""
    context = index.sparkSession.sparkContext
    terms = [np.frombuffer(b.as_py(), np.uint64) for b in own.column("terms")]
    vocabulary = np.unique(np.concatenate(terms))
    shared = context.broadcast(vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            t = batch.column(0).to_numpy().view(np.uint64)
            at = np.searchsorted(vocabulary, t).clip(max=len(vocabulary) - 1)
            hit = vocabulary[at] == t
            yield pa.RecordBatch.from_arrays([pa.array(at[hit]), batch.column(1).filter(pa.array(hit))], names=["term", "df"])

    counts = arrow_map(dfs, frequencies, "term long, df long").toArrow()  # a row for each term of the wave
    df = np.zeros(len(vocabulary))
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    sizes = own.column("m").to_numpy()
    ids = own.column("query_id").to_numpy()
    places = np.searchsorted(vocabulary, np.concatenate(terms)).astype(np.int32)
    weights = np.concatenate([np.frombuffer(c.as_py(), np.int32) for c in own.column("counts")]) * idf[places]
    common = np.argsort(-df, kind="stable")[:ALIKE]
    column = np.full(len(vocabulary), -1)
    column[common] = np.arange(len(common))
    column = column[places]
    held = column >= 0
    looks = np.zeros((len(ids), len(common)), np.float32)
    looks[np.repeat(np.arange(len(ids)), sizes)[held], column[held]] = weights[held]
    looks /= np.maximum(np.sqrt((looks * looks).sum(1)), 1e-30)[:, None]
    starts = np.cumsum(sizes) - sizes
    parts = []
    for part in _alike(looks, sizes):
        chosen = _ranges(starts[part], sizes[part])
        parts.append((ids[part], sizes[part], places[chosen], weights[chosen]))
    wave = context.broadcast(parts)
    sent = [shared, wave]
    every, known = None, {}
    for low, high in levels:
        if every is not None:
            rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
            scores = every.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", "score").toArrow()
            known = dict(zip(*(scores.column(c).to_pylist() for c in ("query_id", "score"))))
        sent.append(context.broadcast([np.array([known.get(q, 0.0) for q in part[0].tolist()]) for part in parts]))
        level = index.where((F.col("draw") >= low) & (F.col("draw") < high))
        found = stored(_searched(level, shared, wave, sent[-1], mean, k, schema), "found")
        every = found if every is None else every.union(found)
    for one in sent:
        one.destroy()
    return every


def _searched(index: DataFrame, shared, wave, known, mean: float, k: int, schema: str) -> DataFrame:
    """The k best of each segment for each query, as far as they reach the score known for the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].values
                lens, terms, dfs, docs, tfs = (batch.column(c)[row].as_buffer() for c in range(1, 6))
                lens, terms = np.frombuffer(lens, np.int32), np.frombuffer(terms, np.uint64)
                dfs = _wide(dfs, len(terms))
                postings = int(dfs.sum())
                docs, tfs = _wide(docs, postings), _wide(tfs, postings)
                segment = Searcher(shared.value, mean, ids.fill_null(LAST).to_numpy(), lens, terms, dfs, docs, tfs)
                for (queries, sizes, places, weights), least in zip(wave.value, known.value):
                    query, found, scores = segment.search_all(sizes, places, weights, k, least)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(queries[query]), ids.take(pa.array(found)), pa.array(scores)], names=["query_id", "doc_id", "score"]
                    )
                del segment

    return arrow_map(index.select("ids", "lens", "terms", "dfs", "docs", "tfs"), run, schema)
