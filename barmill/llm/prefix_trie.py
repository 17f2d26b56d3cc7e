"""Prefix trie of conversations with subtree totals, rolled up in bands of depth.

A node is a distinct sequence of first turns. Its key is the exclusive or of two 64-bit hashes of each turn with its
place, so that a running aggregate gives the keys of all prefixes, also of one conversation that is split over many
tasks. Sequences are told apart by these 128 bits.

Totals go up in bands of BAND depths. A node explodes only to its ancestors within its band. What hangs below the lowest
depth of a band is one number for each node there: these nodes make a trie that is BAND times as flat, rolled up in the
same way first. So a node explodes to BAND ancestors at most, and depth D takes log D / log BAND rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.util import arrow_map, stored

#: Depths of a band: the most ancestors that a node explodes to at a time.
BAND = 16
#: Conversations that share a first part, and the longest first part they may share.
FAMILY, SHARED = 5, 9
#: Ids that one piece of a list of members may span.
IDS = 4096

KEY = ("pos", "ka", "kb")


def _div(x: str, by: int) -> Column:
    return F.expr(f"({x}) div {by}")


def _xor(x: str, y: str) -> Column:
    return F.col(x).bitwiseXOR(F.col(y))


def numbered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, pos (from 1), digest and n_bytes of every turn, by turn, null first; equal turns by their digest.

    Turns are sorted over all tasks by conversation and turn, and numbered from where a task's share of a conversation
    begins. So a conversation that holds a third of all rows is no single task's. No text is shuffled.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = ("conv", "turn", "digest")
    sorted_ = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(
        sorted_.select("conv", "digest", "n_bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns"
    )
    shares = placed.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row for each task that goes on with a conversation: at most as many as there are tasks.
    later = shares.select("conv", "part", before.alias("before")).where("before > 0")
    own = F.row_number().over(Window.partitionBy("conv", "part").orderBy("at"))
    return (
        placed.withColumn("own", own)
        .join(F.broadcast(later), ["conv", "part"], "left")
        .select("conv", (F.col("own") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "n_bytes")
    )


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (conv, pos, digest, n_bytes, n) and all conversations (conv, n).

    A conversation c begins with the first h turns of conversation c - c % family and goes on with its own after the
    first h; h = crc32(c) % shared.
    """
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    c = sizes.select(
        "conv", "own", (F.col("conv") - F.col("conv") % family).alias("base"),
        (F.crc32(F.col("conv").cast("string")) % shared).alias("h"),
    )
    lent = F.least("h", F.coalesce("lender", F.lit(0)))
    convs = c.join(sizes.select(F.col("conv").alias("base"), F.col("own").alias("lender")), "base", "left").select(
        "conv", "base", "h", lent.alias("k"), (lent + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")
    )
    convs = stored(convs, "conversations")
    firsts = turns.where(F.col("pos") < shared).withColumnRenamed("conv", "base")
    early = convs.join(firsts, "base").where("pos <= h").select("conv", "pos", "digest", "n_bytes", "n")
    late = turns.join(convs, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "digest", "n_bytes", "n")
    return early.union(late), convs.select("conv", "n")


def with_keys(rows: DataFrame, longest: int, band: int = BAND) -> DataFrame:
    """rows with ka, kb: the exclusive or of a, b from the first row of a conv to this one, by pos.

    Bands are aggregated apart, and a band begins with what its forerunners came to, found in the same way among bands.
    """
    rows = rows.withColumn("band", _div("pos - 1", band))
    here = Window.partitionBy("conv", "band").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    within = rows.withColumns({"ka": F.bit_xor("a").over(here), "kb": F.bit_xor("b").over(here)})
    if longest <= band:
        return within.drop("band")
    sums = rows.where(F.col("n") > band).groupBy("conv", "band").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), _div(f"max(n) + {band - 1}", band).alias("n"))
    ahead = with_keys(sums.select("conv", (F.col("band") + 1).alias("pos"), "a", "b", "n"), -(-longest // band), band)
    ahead = ahead.select("conv", F.col("pos").alias("band"), F.col("ka").alias("oa"), F.col("kb").alias("ob"))
    zero = F.lit(0).cast("long")
    found = within.join(ahead, ["conv", "band"], "left").withColumns({c: F.coalesce(c, zero) for c in ("oa", "ob")})
    return found.withColumns({"ka": _xor("ka", "oa"), "kb": _xor("kb", "ob")}).drop("band", "oa", "ob")


def rolled_up(nodes: DataFrame, paths: DataFrame, longest: int, totals: tuple[str, ...], band: int = BAND) -> DataFrame:
    """pos, ka, kb and the totals over its subtree of every node; paths must hold the way of each node's conv down to it.

    nodes: pos, ka, kb, conv and a column for each total; paths: conv, pos, ka, kb, and pa, pb, the key one pos higher.
    """
    in_band = Window.partitionBy("conv", "band").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ways = paths.withColumn("band", _div("pos - 1", band)).select(
        "conv", "pos", "band", "ka", "kb",
        F.collect_list(F.struct("ka", "kb")).over(in_band).alias("way"),
        F.first("pa").over(in_band).alias("ua"), F.first("pb").over(in_band).alias("ub"),
    )
    ways = stored(ways, "ways") if longest > band else ways
    placed = nodes.join(ways.drop("ka", "kb"), ["conv", "pos"])
    if longest > band:
        below = placed.where(F.col("pos") > band).groupBy(F.col("band").alias("pos"), F.col("ua").alias("ka"), F.col("ub").alias("kb"))
        hung = below.agg(*(F.sum(t).alias(t) for t in totals))
        lowest = F.col("pos") % band == 0
        flat = nodes.where(lowest).select(_div("pos", band).alias("pos"), "ka", "kb", "conv").join(hung, list(KEY), "left")
        flat_paths = ways.where(lowest).select("conv", _div("pos", band).alias("pos"), "ka", "kb", F.col("ua").alias("pa"), F.col("ub").alias("pb"))
        done = rolled_up(flat.na.fill(0, list(totals)), flat_paths, longest // band, totals, band)
        done = stored(done.select((F.col("pos") * band).alias("pos"), "ka", "kb", *(F.col(t).alias(f"{t}_below") for t in totals)), "band-roots")
        placed = placed.join(done, list(KEY), "left").withColumns({t: F.col(t) + F.coalesce(f"{t}_below", F.lit(0)) for t in totals})
    above = placed.select("band", *totals, F.posexplode("way").alias("step", "node"))
    above = above.select((F.col("band") * band + F.col("step") + 1).alias("pos"), "node.ka", "node.kb", *totals)
    return above.groupBy(*KEY).agg(*(F.sum(t).alias(t) for t in totals))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node's list of members, which come in order; only one state is kept."""
    node, state = None, None
    for batch in batches:
        out = []
        for *key, piece in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if key != node:
                if state:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(f",{piece}".encode())
        if out:
            yield _members(out)
    if state:
        yield _members([(*node, state.hexdigest())])


def _members(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*KEY, "ends_sha256"])


def ends(last: DataFrame) -> DataFrame:
    """pos, ka, kb, ends_sha256 of the nodes at which conversations end.

    A list of ids is made in pieces of a bounded span of ids, and a node's pieces are digested one after the other.
    """
    pieces = last.groupBy(*KEY, _div("conv", IDS).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")
    )
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
    return arrow_map(ordered, _digests, "pos long, ka long, kb long, ends_sha256 string")


def trie(df: DataFrame, band: int = BAND) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. A
    null role or text counts as empty, a null turn comes first, and turns of equal number are taken by a digest of role
    and text, repeated ones as often as they stand. Rows without conv_id belong to no conversation. An empty table has
    no node. Other columns of df are not looked at.
    """
    turns = stored(numbered(df), "numbered")
    rows, convs = rebuilt(turns)
    longest = convs.agg(F.max("n")).first()[0] or 0
    hashed = rows.withColumns({"a": F.xxhash64("pos", "digest"), "b": F.xxhash64("digest", "pos", F.lit(1))}).drop("digest")
    paths = stored(
        with_keys(hashed, longest, band).select("conv", "pos", "n", "n_bytes", "ka", "kb", _xor("ka", "a").alias("pa"), _xor("kb", "b").alias("pb")), "paths"
    )
    inner = paths.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("pos"), zero.alias("ka"), zero.alias("kb"), "conv", "n_convs", zero.alias("n_bytes"), none.alias("pa"), none.alias("pb")
    )
    every = inner.union(root)
    children = inner.groupBy((F.col("pos") - 1).alias("pos"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count("*").alias("n_children"))
    nodes = stored(
        every.join(children, list(KEY), "left").withColumns(
            {
                "n_children": F.coalesce("n_children", zero),
                "n_leaves": F.col("n_children").isNull().cast("long"),
                "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes"),
            }
        ),
        "nodes",
    )
    totals = ("n_leaves", "saved_tokens")
    deep = nodes.where("pos > 0").select(*KEY, "conv", *totals)
    summed = rolled_up(deep, paths.select("conv", *KEY, "pa", "pb"), longest, totals, band)
    whole = nodes.groupBy(*(zero.alias(k) for k in KEY)).agg(*(F.sum(t).alias(t) for t in totals))
    last = paths.where("pos = n").select(*KEY, "conv").union(convs.where("n = 0").select(zero.alias("pos"), zero.alias("ka"), zero.alias("kb"), "conv"))
    above = nodes.select((F.col("pos") + 1).alias("pos"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv").alias("parent_conv_id"))
    return (
        nodes.drop(*totals)
        .join(summed.union(whole), list(KEY))
        .join(ends(last), list(KEY), "left")
        .join(above, ["pos", "pa", "pb"], "left")
        .select(
            F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), "parent_conv_id", "n_convs", "n_children", *totals,
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
