"""The mix against its constraints and against a solver by bisection."""

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barmill.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def targets(sizes):
    """Shares by weight in order of code points, null last; the excess over twice a source goes to the others."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, out = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in out]
        left = total - sum(out.values())
        full = [s for s in rest if left * weight[s] / sum(weight[r] for r in rest) >= 2 * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        out |= {s: 2.0 * sizes[s] for s in full}


def multiplier(sizes, target):
    mean = sum(sizes) / len(sizes)
    low, high = -200.0, 200.0
    for _ in range(200):
        m = (low + high) / 2
        if sum(s * min(2, math.exp(min(m * s / mean, 50))) for s in sizes) < target:
            low = m
        else:
            high = m
    return low, mean


def checked(rows, found):
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    by = defaultdict(list)
    for i, _, s in rows:
        by[s].append(sizes[i])
    want = targets({s: sum(v) for s, v in by.items()})
    source = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in found:
        s = source[r.doc_id]
        assert r.size == sizes[r.doc_id] and r.source_size == sum(by[s])
        assert r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
        if 0 < want[s] < 2 * sum(by[s]):
            m, mean = multiplier(by[s], want[s])
            assert r.size == 0 or r.rate == pytest.approx(min(2, math.exp(m * r.size / mean)), rel=1e-3)
            assert abs(r.copies - r.rate) < 2
    return {s: (taken[s], want[s]) for s in want}


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    for got, want in checked(rows, found).values():
        assert got == pytest.approx(want, rel=0.01)
    again = mixing.mix(docs.repartition(5)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in found}
    copies = mixing.mixed(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in copies} == {r.doc_id: r.copies for r in found if r.copies}


def test_hot_source_and_many_equal_sizes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 20)
    rows = [(i, "w " * (5 if i % 2 else 40), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(900)]
    for got, want in checked(rows, mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()).values():
        assert got == pytest.approx(want, rel=0.01)


def test_edges(spark):
    rows = [(1, "a b c d", "x"), (2, None, "x"), (3, "", None), (4, "a b", None), (None, "q r s", "é"), (6, "\x0b\t ", "empty"), (7, "one", "Z")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("mine")).withColumn("n", F.lit(1)).withColumn("target", F.lit(1))
    found = mixing.mix(df).collect()
    checked(rows, found)
    assert len(found) == len(rows) and all(r.taken == 0 for r in found if r.doc_id in (2, 3, 6))
    assert mixing.mixed(df.withColumn("_row", F.lit(1))).columns == [*df.columns, "_row"]
    assert mixing.mixed(df.where("false")).count() == 0
    assert mixing.mix(df.where("false")).count() == 0
    twice = df.where("doc_id = 1").union(df.where("doc_id = 1"))
    assert [r.size for r in mixing.mix(twice).collect()] == [4, 4]


def test_rows_that_share_an_id(spark):
    rows = [(7 if i % 3 else None, f"{'w ' * (1 + i % 5)}{i // 4}", f"s{i % 3}") for i in range(120)] + [(7, "same words here", "s1")] * 30
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    plan = mixing.mix(df).groupBy("doc_id", "size", "source_size").agg(F.sum("copies").alias("copies")).collect()
    size = F.size(F.split("text", " "))
    got = {(r.doc_id, r.size, r.source): r.n for r in mixing.mixed(df).groupBy("doc_id", size.alias("size"), "source").agg(F.count("*").alias("n")).collect()}
    assert sum(got.values()) == sum(r.copies for r in plan) > 0
    by = defaultdict(int)
    for (i, n, _), count in got.items():
        by[i, n] += count
    want = defaultdict(int)
    for r in plan:
        want[r.doc_id, r.size] += r.copies
    assert dict(by) == {k: v for k, v in want.items() if v}
    each = mixing.mixed(df).groupBy("doc_id", "text", "source").count().collect()
    have = defaultdict(int)
    for r in rows:
        have[r] += 1
    assert all(r["count"] <= 2 * have[r.doc_id, r.text, r.source] for r in each)
    assert sorted(map(repr, each)) == sorted(map(repr, mixing.mixed(df).groupBy("doc_id", "text", "source").count().collect()))
