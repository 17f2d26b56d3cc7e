"""Block-max search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barmill.llm import wand

SCHEMA = "doc_id long, text string"


def bag(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def brute(rows, queries, k):
    bags = [bag(t) for _, t in rows]
    df = Counter(w for b in bags for w in b)
    n, mean = len(rows), sum(sum(b.values()) for b in bags) / max(len(rows), 1)
    out = {}
    for q, text in queries:
        scores = []
        for (d, _), b in zip(rows, bags):
            size = sum(b.values())
            s = 0.0
            for w, times in bag(text).items():
                if w in b:
                    idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    s += times * idf * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size / mean))
            if s > 0:
                scores.append((-s, d is None, d))
        out[q] = sorted(scores, key=lambda x: (round(x[0], 9), x[1], x[2] or 0))[:k]
    return out


def same(found, want):
    by = {}
    for r in found.orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {q for q, best in want.items() if best}
    for q, rows in by.items():
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == len(want[q])
        assert [r.score for r in rows] == pytest.approx([-s for s, _, _ in want[q]])
        assert [r.doc_id for r in rows] == [d for _, _, d in want[q]]


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    queries = docs.where(F.col("doc_id") % 10 == 0).select(F.col("doc_id").alias("query_id"), "text")
    want = brute(rows, [tuple(r) for r in queries.collect()], 10)
    same(wand.search(wand.build_index(docs.repartition(3), segment=50), queries), want)
    same(wand.search(wand.build_index(docs), queries, wave=2000), want)


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(3, "a b c"), (1, "a b c"), (2, "A B c"), (None, "a b c"), (5, None), (6, ""), (7, "z z z z"), (7, "z z z z"), (8, "z")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("terms", F.lit(0)).withColumn("ids", F.lit("x"))
    queries = spark.createDataFrame([(1, "a b"), (2, "q"), (3, None), (4, "z"), (None, "a")], "query_id long, text string")
    want = brute(rows, [(1, "a b"), (2, "q"), (3, None), (4, "z")], 3)
    same(wand.search(wand.build_index(df, segment=2), queries, k=3), want)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    queries = spark.createDataFrame([(1, "a")], "query_id long, text string")
    assert wand.search(wand.build_index(none), queries).count() == 0
    docs = spark.createDataFrame([(1, "a")], SCHEMA)
    assert wand.search(wand.build_index(docs), queries.where("false")).count() == 0


def test_blocks_are_pruned():
    rnd = random.Random(2)
    terms = np.arange(50, dtype=np.uint64)
    docs, tfs, dfs = [], [], []
    for t in terms:
        own = sorted(rnd.sample(range(4000), 30 if t < 40 else 2000))
        docs += own
        tfs += [rnd.choice((1, 1, 1, 9)) for _ in own]
        dfs.append(len(own))
    lens = np.array([rnd.randrange(20, 400) for _ in range(4000)], np.int32)
    s = wand.Searcher(terms, lens.mean(), np.arange(4000), lens, terms, np.array(dfs, np.int32), np.array(docs, np.int32), np.array(tfs, np.int32))
    asked, weights = np.array([0, 1, 2, 45]), np.array([5.0, 5.0, 5.0, 0.1])
    found, scores = s.search(asked, weights, 5)
    assert 0 < s.opened < s.n_blocks
    starts = np.cumsum(dfs) - dfs
    full = np.zeros(4000)
    for t, w in zip(asked, weights):
        at = slice(starts[t], starts[t] + dfs[t])
        full[np.array(docs)[at]] += w * s.impact[at]
    best = np.lexsort((np.arange(4000), -full))[:5]
    assert found.tolist() == best.tolist() and scores == pytest.approx(full[best])


def random_segment(rnd, n, kinds):
    """A segment of two languages whose texts have a few words in common, and many words of their own."""
    rows = {}
    lens = np.zeros(n, np.int32)
    for doc in range(n):
        for _ in range(rnd.randrange(0, 60)):
            word = doc % 2 * kinds + int(kinds * rnd.random() ** 3)
            rows[word, doc] = rows.get((word, doc), 0) + rnd.choice((1, 1, 1, 7, 300))
    for (_, doc), times in rows.items():
        lens[doc] += times
    terms = np.array(sorted({w for w, _ in rows}), np.uint64)
    dfs = np.array([sum(1 for w, _ in rows if w == t) for t in terms.tolist()], np.int32)
    keys = sorted(rows)
    return lens, terms, dfs, np.array([d for _, d in keys], np.int32), np.array([rows[key] for key in keys], np.int32)


@pytest.mark.parametrize("sizes", [{}, {"RATE": 10**9}, {"ROWS": 3, "ENTRIES": 600}, {"COLUMNS": 5, "RATE": 10**9}])
def test_queries_are_searched_together(monkeypatch, sizes):
    rnd = random.Random(5)
    n, k = 300, 4
    lens, terms, dfs, docs, tfs = random_segment(rnd, n, 60)
    for name, value in sizes.items():
        monkeypatch.setattr(wand, name, value)
    ids = np.array([rnd.randrange(n // 2) for _ in range(n - 1)] + [wand.LAST])
    vocabulary = np.unique(np.concatenate((terms[::2], np.arange(500, 520, dtype=np.uint64))))  # not all terms are asked for, some are nowhere
    s = wand.Searcher(vocabulary, lens.mean(), ids, lens, terms, dfs, docs, tfs, block=8)
    asked = [np.sort(rnd.sample(range(len(vocabulary)), rnd.choice((1, 5, 40)))) for _ in range(50)] + [np.empty(0, int)]
    weights = [np.array([rnd.random() * 5 for _ in q]) for q in asked]
    full = np.zeros((len(asked), n))
    at = dict(zip(terms.tolist(), np.cumsum(dfs) - dfs))
    for q, (own, w) in enumerate(zip(asked, weights)):
        for t, x in zip(vocabulary[own].tolist(), w):
            if t in at:
                part = slice(at[t], at[t] + dfs[terms.tolist().index(t)])
                impact = tfs[part] * (wand.K1 + 1) / (tfs[part] + wand.K1 * (1 - wand.B + wand.B * lens[docs[part]] / lens.mean()))
                full[q, docs[part]] += x * impact
    known = np.array([rnd.choice((0.0, np.sort(scores)[-k], np.sort(scores)[-1], scores.max() * 2)) for scores in full])
    query, found, scores = s.search_all(np.array([len(q) for q in asked]), np.concatenate(asked), np.concatenate(weights), k, known)
    for q in range(len(asked)):
        order = [d for d in np.lexsort((ids, -full[q].round(9))) if full[q, d] > 0 and full[q, d] >= known[q] * (1 - 1e-12)][:k]
        assert scores[query == q] == pytest.approx(full[q, order])
        assert ids[found[query == q]].tolist() == ids[order].tolist()
        alone = s.search(asked[q], weights[q], k, known[q])
        assert alone[0].tolist() == found[query == q].tolist() and alone[1].tolist() == scores[query == q].tolist()


def test_like_queries_come_together(monkeypatch):
    monkeypatch.setattr(wand, "TOGETHER", 8)
    monkeypatch.setattr(wand, "TERMS", 60)
    rng = np.random.default_rng(1)
    looks = np.zeros((40, 6), np.float32)
    looks[::2, :3], looks[1::2, 3:] = rng.random((20, 3)) + 1, rng.random((20, 3)) + 1
    sizes = np.array([5] * 39 + [1000])
    parts = wand._alike(looks, sizes)
    assert sorted(np.concatenate(parts).tolist()) == list(range(40))
    assert all(len(p) == 1 or len(p) <= 8 and sizes[p].sum() <= 60 for p in parts)
    assert sum(len(set((p % 2).tolist())) > 1 for p in parts) <= 1
    assert sorted(np.concatenate(wand._alike(np.zeros((20, 0), np.float32), np.ones(20, int))).tolist()) == list(range(20))


def test_levels_of_segments(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(d, " ".join(f"w{int(40 * rnd.random() ** 2)}" for _ in range(rnd.randrange(1, 20)))) for d in range(280)]
    rows += [(280, "w1 " * 300), (281, "w2 " * 70_000)]
    queries = [(d, t) for d, t in rows if d % 20 == 0]
    met, whole = [], wand._searched
    monkeypatch.setattr(wand, "_searched", lambda index, *rest: met.append(index.count()) or whole(index, *rest))
    found = wand.search(wand.build_index(spark.createDataFrame(rows, SCHEMA).coalesce(2), segment=3), spark.createDataFrame(queries, "query_id long, text string"))
    same(found, brute(rows, queries, 10))
    assert len(met) == 3 and sum(met) in (94, 95)
    assert met[0] <= 8 and met[0] + met[1] <= 30
