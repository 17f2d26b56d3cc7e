"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barmill.llm import components, shingle_join
from barmill.llm.shingles import set_id, shingles

SCHEMA = "doc_id long, text string"


def sets_of(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))}


def brute(rows, k, percent):
    sets = [sets_of(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def family(seed, copies, length, edits, first_id):
    """A text and near copies, some of them copies of copies, so that chains arise."""
    rnd = random.Random(seed)
    vocabulary = [f"w{seed}x{i}" for i in range(400)]
    texts = [[rnd.choice(vocabulary) for _ in range(length)]]
    for _ in range(copies):
        new = list(rnd.choice(texts))
        for _ in range(rnd.randrange(edits + 1)):
            new[rnd.randrange(len(new))] = rnd.choice(vocabulary)
        texts.append(new[: len(new) - rnd.randrange(3)])
    return [(first_id + i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_all_pairs(spark, k, percent):
    rows = family(1, 40, 120, 4, 0) + family(2, 30, 30, 2, 100) + family(3, 20, 10, 1, 200) + family(4, 25, 60, 9, 300)
    passage = " ".join(f"common{i}" for i in range(60))
    rows += [(400 + i, f"{passage} own{i} text{i} here{i} " + " ".join(f"z{i}y{j}" for j in range(i % 9))) for i in range(40)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "one\x0btwo"), (507, "É é")]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(shingle_join.similar_documents(df, k=k, percent=percent)) == brute(rows, k, percent)


def test_hot_tokens_and_small_groups_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "HOT_LOCAL", 2)
    monkeypatch.setattr(shingle_join, "HOT_GLOBAL", 2)
    monkeypatch.setattr(shingle_join, "PART", 3)
    monkeypatch.setattr(shingle_join, "MEET", 300)
    rows = family(7, 60, 80, 8, 0) + family(8, 60, 80, 5, 100)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(shingle_join.similar_documents(df, k=3, percent=90)) == brute(rows, 3, 90)


def test_bitmaps_differ_by_tokens_of_one_set_only():
    rnd = random.Random(11)
    for n in (0, 1, 30, 900):
        a = {rnd.randrange(1 << 64) for _ in range(n)}
        b = {x for x in a if rnd.random() < 0.9} | {rnd.randrange(1 << 64) for _ in range(n // 9)}
        x, y = (shingle_join.marks(np.array(sorted(s), np.uint64)) for s in (a, b))
        differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert len(x) == len(shingle_join.MARKS) and differ <= len(a ^ b) and (len(a ^ b) - differ) % 2 == 0
        assert n != 30 or differ > 0


def test_quoting_one_passage_opens_few_groups(spark, monkeypatch):
    cells, stored = [], shingle_join.stored
    monkeypatch.setattr(shingle_join, "stored", lambda df, what: (out := stored(df, what), cells.append(out.count()) if what == "cells" else None)[0])
    passage = " ".join(f"common{i}" for i in range(60))
    rows = [(i, f"{passage} " + " ".join(f"own{i}x{j}" for j in range(5))) for i in range(60)] + family(12, 20, 60, 3, 100)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(shingle_join.similar_documents(df, k=3, percent=90)) == brute(rows, 3, 90)
    assert len(cells) == 1 and cells[0] < 400  # of 1,770 pairs of those that quote


def edited(rnd, words, times, kind):
    new = list(words)
    for i in rnd.sample(range(len(new)), times):
        new[i] = f"{kind}{rnd.randrange(10**6)}"
    return " ".join(new)


def test_near_copies_that_do_not_link_meet_in_few_pairs(spark, monkeypatch):
    seen, compared = [], shingle_join._compared
    monkeypatch.setattr(shingle_join, "_compared", lambda pairs, *rest: (seen.append(pairs.count()), compared(pairs, *rest))[1])
    rnd = random.Random(13)
    words = [f"t{i}" for i in range(150)]
    rows = [(i, edited(rnd, words, rnd.choice((1, 2)), "e")) for i in range(70)]  # these link to the text
    rows += [(100 + i, edited(rnd, words, rnd.choice((4, 5)), "f")) for i in range(70)] + [(200, " ".join(words))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(shingle_join.similar_documents(df, k=3, percent=90)) == brute(rows, 3, 90)
    assert sum(seen) < 1500  # 70 * 71 pairs of those that link and those that do not


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_the_search_finds_what_grouping_left(spark, monkeypatch, k, percent):
    pivots = shingle_join._to_pivots
    monkeypatch.setattr(shingle_join, "_to_pivots", lambda *x: pivots(*x).where(F.pmod(F.xxhash64("a"), F.lit(3)) == 0))
    monkeypatch.setattr(shingle_join, "PART", 4)
    rnd = random.Random(percent)
    words = [f"t{i}" for i in range(80)]
    rows = [(i, edited(rnd, words, rnd.randrange(7), "e")) for i in range(60)]
    rows += family(21, 50, 80, 6, 100) + family(22, 40, 25, 2, 200)
    extra = " ".join(f"x{i}" for i in range(9))  # a change that many share
    rows += [(300 + i, f"{edited(rnd, words, rnd.randrange(3), 'g')} {extra}") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(shingle_join.similar_documents(df, k=k, percent=percent)) == brute(rows, k, percent)


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert got(shingle_join.similar_documents(docs, k=3, percent=90)) == brute(rows, 3, 90)


def test_repeated_ids_nulls_and_other_columns(spark):
    text = " ".join(f"a{i}" for i in range(50))
    rows = [(1, text), (1, text), (2, text + " b"), (None, text), (None, "c d e f g"), (3, "x y z"), (3, "p q r")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("token", F.lit("t")).withColumn("n", F.lit(2))
    assert got(shingle_join.similar_documents(df, k=3, percent=90)) == brute(rows, 3, 90)
    kept = sorted(((r.doc_id, r.text) for r in shingle_join.first_of_each(df, k=3, percent=90).collect()), key=repr)
    assert kept == sorted([(1, text), (None, "c d e f g"), (3, "x y z"), (3, "p q r")], key=repr)
    assert shingle_join.first_of_each(df).columns == df.columns


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert got(shingle_join.similar_documents(df)) == []
    assert got(shingle_join.first_of_each(df)) == []


def test_one_of_each(spark):
    rows = family(9, 30, 60, 3, 0) + [(90, None), (91, None), (92, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {c for _, n, c in brute(rows, 5, 80) if n} | {90, 91, 92}
    assert sorted(r.doc_id for r in shingle_join.first_of_each(df).collect()) == sorted(want)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101 + i) for i in range(30)] + [(7, 7), (300, 200), (200, 300)]
    df = spark.createDataFrame(chain, "a long, b long")
    found = dict(tuple(r) for r in components.components(df).collect())
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(31)} | {200: 200, 300: 200}


def test_shingles_by_pieces(monkeypatch):
    text = " ".join(f"word{i % 700}" for i in range(9000)) + " " + "x" * 5000 + " end"
    whole = shingles(text, 3)
    monkeypatch.setattr("barmill.llm.shingles.PIECE", 1000)
    assert (shingles(text, 3) == whole).all() and len(whole) == len(sets_of(text, 3))
    assert set_id(whole) != set_id(whole[1:])
