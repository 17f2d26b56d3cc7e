"""Context-tree weighting against a plain context tree."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barmill.llm import context_tree, queries

SCHEMA = "doc_id long, text string"


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def stream(text):
    return b" ".join(w.encode() for w in words(text)) + b"\n"


def nodes_of(data, at):
    """For each bit of a byte: the choices of the contexts of 0 to DEPTH bytes, and the bit."""
    before = (b"\n" * context_tree.DEPTH + data[:at])[-context_tree.DEPTH :]
    for bit in range(8):
        made = data[at] >> (8 - bit)
        yield [(before[context_tree.DEPTH - d :], bit, made) for d in range(context_tree.DEPTH + 1)], data[at] >> (7 - bit) & 1


def plain(rows):
    counts = defaultdict(lambda: [0, 0])
    unigrams = Counter()
    for doc, text in rows:
        if not held(doc):
            unigrams.update([*words(text), None])
            data = stream(text)
            for at in range(len(data)):
                for path, bit in nodes_of(data, at):
                    for node in path:
                        counts[node][bit] += 1
    kt, children = {}, defaultdict(list)
    for node, (a, b) in counts.items():
        kt[node] = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        if node[0]:
            children[(node[0][1:], *node[1:])].append(node)
    weighted = {}
    for node in sorted(counts, key=lambda x: -len(x[0])):
        if len(node[0]) == context_tree.DEPTH:
            weighted[node] = kt[node]
        else:
            weighted[node] = np.logaddexp(math.log(0.5) + kt[node], math.log(0.5) + sum(weighted[c] for c in children[node]))
    total, kinds = sum(unigrams.values()), len(unigrams)
    out = []
    for doc, text in rows:
        data, log10 = stream(text), 0.0
        for at in range(len(data)):
            for path, bit in nodes_of(data, at):
                chance, left = 0.0, 1.0
                for node in path:
                    c = counts.get(node, (0, 0))
                    if len(node[0]) == context_tree.DEPTH:
                        stop = 1.0
                    else:
                        stop = math.exp(math.log(0.5) + kt[node] - weighted[node]) if node in kt else 0.5
                    chance += left * stop * (c[bit] + 0.5) / (sum(c) + 1)
                    left *= 1 - stop
                log10 += math.log10(chance)
        tokens = [*words(text), None]
        base = sum(math.log10((unigrams[t] + 1) / (total + kinds + 1)) for t in tokens)
        out.append((doc, held(doc), len(tokens), sum(unigrams[t] > 0 for t in tokens), total, base, log10))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [x for r in got for x in r[5:]] == pytest.approx([x for r in want for x in r[5:]], rel=1e-9)


def texts(seed, n):
    rnd = random.Random(seed)
    lexicon = ["the", "cat", "Über", "sat", "on", "12", "mat", "naïve", "日本", "x" * 30]
    return [(k, " ".join(rnd.choice(lexicon) for _ in range(rnd.choice([0, 1, 3, 20, 60])))) for k in range(n)]


@pytest.mark.parametrize("size", [64, 700, 1 << 20])
def test_scores_like_plain(spark, size):
    rows = [*texts(size, 40), (500, None), (501, ""), (502, " \t\n "), (None, "the cat"), (7, "mat mat"), (7, "mat mat"), (503, "y" * 900 + " z" * 300)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit("mine"), "score": F.lit(1), "block": F.lit(2)}).repartition(3)
    same(context_tree.score(df, size=size).collect(), plain(rows))


def test_nothing_to_learn_from(spark):
    doc = next(k for k in range(100) if held(k))
    rows = [(doc, "ab c"), (doc, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.n_tokens: r for r in context_tree.score(df).collect()}
    assert got[3].score == pytest.approx(5 * 8 * math.log10(0.5)) and got[1].score == pytest.approx(8 * math.log10(0.5))
    assert {r.train_tokens for r in got.values()} == {0} and {r.base_score for r in got.values()} == {0.0} and {r.n_known for r in got.values()} == {0}
    assert context_tree.score(df.where("false")).collect() == []


def test_query_on_whole_table(spark, sf_dir):
    found = queries.op12_context_tree(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = found.collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    unigrams = Counter(t for d, text in rows.items() if not held(d) for t in [*words(text), None])
    total, kinds = sum(unigrams.values()), len(unigrams)
    for r in got:
        tokens = [*words(rows[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(tokens), sum(unigrams[t] > 0 for t in tokens), total)
        assert r.base_score == pytest.approx(sum(math.log10((unigrams[t] + 1) / (total + kinds + 1)) for t in tokens))
        assert r.score < 0
    out = [r for r in got if r.held_out]
    bits = -sum(r.score for r in out) / math.log10(2) / sum(len(stream(rows[r.doc_id])) for r in out)
    assert 1 < bits < 2.5  # of eight bits a byte


def test_probabilities_add_up():
    """Every byte after a context: the chances of all 256 add up to one."""
    rnd = np.random.default_rng(1)
    context = rnd.integers(0, 256, 4, np.uint64)
    keys = sum(int(c) << 8 * (4 - k) for k, c in enumerate(context)) + np.arange(256, dtype=np.uint64)
    tree = context_tree.Tree(keys.astype(np.uint64), rnd.integers(0, 5, 256))
    table = np.zeros((3, 256, 256))
    last, choice, zeros, ones, below = tree.top()
    for t, v in zip(table, (zeros, ones, below), strict=True):
        np.add.at(t, (last.astype(int), choice.astype(int)), v)
    chances = tree.log_probability(*context_tree.mixed_down(*table))
    assert np.exp(chances).sum() == pytest.approx(1)
