"""The conversation prefix trie against a plain trie."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barmill.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    totals = {}
    for node in sorted(members, key=len, reverse=True):  # deepest first, so that children are done
        kids = children[node]
        own_bytes = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(totals[k][0] for k in kids) or 1, own_bytes + sum(totals[k][1] for k in kids))
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in who if len(built[c]) == len(node))
        out.append((who[0], len(node), members[node[:-1]][0] if node else None, len(who), len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, band=prefix_trie.BAND):
    return sorted((tuple(r) for r in prefix_trie.trie(df, band).select(*COLUMNS).collect()), key=repr)


def conversations(seed, n):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-60, 200), n):
        for turn in range(rnd.choice([1, 2, 3, 5, 9, 14])):
            role, text = rnd.choice([("user", "a"), ("user", "b"), ("assistant", "é"), (None, "a"), ("user", None)])
            rows.append((c, turn if rnd.random() > 0.05 else None, role, text))
    return rows


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_like_plain(spark, band):
    rows = conversations(band, 80)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(df, band) == plain(rows)


def test_query_like_plain(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in queries.op11_prefix_trie(spark, sf_dir).select(*COLUMNS).collect()), key=repr)
    assert len(got) > 100 and got == plain(rows)


def test_long_and_equal_conversations(spark):
    long = [(10, t, "user", f"t{t % 7}") for t in range(150)] + [(15, t, "user", f"t{t % 7}") for t in range(150)]
    same = [(c, t, "user", "x" * 1000) for c in range(1000, 1040) for t in range(3)]
    again = [(50, 1, "user", "tie")] * 3 + [(50, 1, "assistant", "tie"), (None, 0, "user", "lost"), (7, 0, "user", "gone")]
    rows = long + same + again
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit("mine"), "n": F.lit(1), "conv": F.lit(None).cast("string")})
    assert found(df, 4) == plain(rows)


def test_turnless_and_empty(spark):
    c = next(c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    empty = hashlib.sha256(str(c).encode()).hexdigest()
    assert found(spark.createDataFrame(rows, SCHEMA)) == [(c, 0, None, 1, 0, 1, 0, empty)] == plain(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []


def test_list_of_members_in_pieces(spark):
    ids = [-9000, -5, 0, 4095, 4096, 99999, 1 << 40]
    df = spark.createDataFrame([(1, 5, 6, i) for i in ids] + [(1, 5, 7, 3)], "pos long, ka long, kb long, conv long")
    got = {r.kb: r.ends_sha256 for r in prefix_trie.ends(df).collect()}
    assert got == {6: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 7: hashlib.sha256(b"3").hexdigest()}
