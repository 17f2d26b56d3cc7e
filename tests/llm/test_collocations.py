"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barmill.llm import collocations

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, longest=5, least=100, most=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        held = [(p, a) for p, a in counts.items() if len(p) > 1 and a >= least]
        found = []
        for p, a in held:
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in held)
            if not inside:
                cuts = []
                for k in range(1, len(p)):
                    left, right = counts[p[:k]], counts[p[k:]]
                    cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def documents(seed, n):
    rnd = random.Random(seed)
    lexicon = ["the", "Of", "über", "日本", "a", "b", "c", "d-d", "nbsp x"]
    stock = ["the quick brown fox", "New York city hall today", "a b", "über Alles", "b a b a b a"]
    rows = []
    for k in range(n):
        parts = [rnd.choice(stock) if rnd.random() < 0.4 else rnd.choice(lexicon) for _ in range(rnd.choice([0, 2, 9, 40]))]
        text = "".join(p + rnd.choice([" ", " ", " ", "  ", "\t", ", ", "!\n", " . "]) for p in parts)
        rows.append((k, text, rnd.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("size", [60, 900, 1 << 20])
def test_phrases_like_plain(spark, size):
    rows = [*documents(size, 120), (900, None, "en"), (901, "", "xx"), (902, "the the the the the", "de"), (903, "w" * 400 + " the quick brown fox", "en")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit("mine"), "size": F.lit(1), "phrase": F.lit(None)}).repartition(3)
    got = sorted(tuple(r) for r in collocations.mine(df, least=5, size=size).collect())
    want = plain(rows, least=5)
    assert len(want) > 30 and got == want
    assert sorted(tuple(r) for r in collocations.mine(df, least=9, most=4, longest=3, size=size).collect()) == plain(rows, 3, 9, 4)


def test_scores_past_64_bits(spark):
    big = 3 * 10**12
    rows = [("en", 0, None, 4 * 10**15), ("en", 1, "x", big), ("en", 1, "y", big + 1), ("en", 2, "x y", big - 1)]
    df = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    assert [tuple(r) for r in collocations.scored(df).collect()] == [
        ("en", "x y", big - 1, big, big + 1, 4 * 10**15, 1000 * (big - 1) * 4 * 10**15 // (big * (big + 1)))
    ]


def test_nothing_frequent(spark):
    df = spark.createDataFrame([(1, "a b", "en"), (2, None, None)], SCHEMA)
    assert collocations.mine(df).collect() == [] == collocations.mine(df.where("false")).collect()


def test_streams_are_sorted_once_each(spark):
    df = spark.createDataFrame([("en", 0, None, 9)], "lang string, size int, phrase string, n long")
    plan = collocations.scored(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 2 and plan.count("hashpartitioning") <= 2
    assert plan.count("Sort [lang") <= 4
