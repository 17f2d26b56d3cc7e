"""Exact n-gram Jaccard join with a token-group matrix.

Documents with the same shingle set are one node. Similar nodes are put into groups, the matrix says which tokens a
group's members have together, and a query opens a group only if enough of its tokens are in that union: a member with
Jaccard t or more holds at least t of the query's tokens.

1. Index. Of a set of n tokens at most n - ceil(t * n) are missing in a set that is similar to it. So under any one
   order of tokens, the first l tokens that two similar sets have in common are among the first n - ceil(t * n) + l of
   each: the cells of the matrix are filled for these index tokens only, and similar sets share l of them. Nodes that
   share fewer with all others together are out. Hot tokens come last in the order; which ones count as hot changes
   the work and not the result.
2. Grouping. Of the nodes of a token the most central one is its pivot, the one whose tokens most nodes have: of
   copies of a text that is the text itself. Each node is compared with the pivot that most of its index tokens name,
   in GROUPING rounds, the later ones between components. Components, cut into parts of at most PART nodes, are the groups, single
   nodes included.
3. Search. A token whose nodes are still in different components makes a query of each node against the groups of
   the others. Of the l index tokens that similar sets share, the rarest is followed by l - 1 others in the lists of
   both, so queries and members leave out their l - 1 most frequent index tokens here, and of tokens that the same
   nodes have one is enough. Each set has a bitmap in which every token turns one bit over; where a query's bits differ
   from those that all members of a group agree on, a token is in one set only, so too many such bits (that is most
   groups that only quote a passage of the query's) rule the group out at once. A group is opened if it has enough of the query's index tokens, and then enough of its whole set, in its union. Queries
   and members of opened groups are described by what they change in their component's most central member: a query is
   compared on whole sets with the member that changes least, and with those that share one of its rarest changes. So
   many near copies that are not similar to each other do not meet in pairs.

Pairs inside one component need no comparison, since the result is what is reachable; every pair of different components
that could be linked is compared. So a group of copies costs one comparison a copy, and no group emits its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.components import components
from barmill.llm.shingles import set_id, shingles
from barmill.llm.util import SLICE, arrow_map, slices, stored

#: Most nodes in a group of the matrix.
PART = 64
#: Tokens that are ordered last; the longest list, which is broadcast (8 bytes each).
HOT_LIST = 200_000
#: Nodes of one block of tokens, and of all, from which a token is hot.
HOT_LOCAL, HOT_GLOBAL = 4, 32
BLOCK = 1 << 20
#: Bits of the map of nodes whose sets are needed; it is broadcast.
BITMAP = 1 << 25
#: Columns of 64 bits with a set's bitmap.
MARKS = [f"m{k}" for k in range(4)]
#: Rounds in which nodes are compared with pivots.
GROUPING = 2
#: Index tokens that meet in one task, about.
MEET = 1 << 20


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def shared_least(n, percent: int):
    """Index tokens that a set of n tokens shares with any similar one: as many as the shortest sufficient prefix has.

    For numbers and for columns; the smallest set that can be similar decides.
    """
    least = _div(percent * n + 99, 100)
    return least - _div(percent * least + 99, 100) + 1


def _div(a, b: int):
    return F.floor(a / b) if isinstance(a, Column) else a // b


def _described(df: DataFrame, k: int) -> DataFrame:
    """Rows of two kinds: doc_id, n, node of a document; token and count of tokens that are frequent in a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, seen = 0, set()
        none = pa.nulls

        def frequent() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            tokens, counts = tokens[counts >= HOT_LOCAL].astype(np.int64), counts[counts >= HOT_LOCAL]
            m = len(tokens)
            return pa.RecordBatch.from_arrays(
                [none(m, kind), none(m, pa.int64()), none(m, pa.int64()), pa.array(tokens), pa.array(counts)], names=names
            )

        names, kind = ["doc_id", "n", "node", "token", "c"], None
        for batch in batches:
            kind = batch.column(0).type
            ns, nodes = [], []
            for text in batch.column(1):
                tokens = shingles(text.as_py(), k)
                node = set_id(tokens) if len(tokens) else None
                ns.append(len(tokens))
                nodes.append(node)
                if node is not None and node not in seen:  # copies within a block count once
                    seen.add(node)
                    held.append(tokens)
                    size += len(tokens)
                if size > BLOCK:
                    yield frequent()
                    held, size, seen = [], 0, set()
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), none(m, pa.int64()), none(m, pa.int64())],
                names=names,
            )
        if held:
            yield frequent()

    kind = df.schema["doc_id"].dataType.simpleString()
    return arrow_map(df, run, f"doc_id {kind}, n long, node long, token long, c long")


def _index(df: DataFrame, k: int, percent: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """bucket and packed tokens, nodes and sizes: the first tokens of each node in the order (hot, hash)."""
    shared = df.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, seen = shared.value, set()
        tokens: list[np.ndarray] = []
        nodes: list[tuple[int, int, int]] = []

        def packed() -> pa.RecordBatch:
            all_tokens = np.concatenate(tokens)
            owner = np.repeat(np.arange(len(nodes)), [x[2] for x in nodes])
            to = (all_tokens % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            to, all_tokens, owner = to[order], all_tokens[order], owner[order]
            cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            ids, sizes = np.array([x[0] for x in nodes], np.int64), np.array([x[1] for x in nodes], np.int64)
            rows = [[], [], [], [], []]
            for low, high in zip(cuts, [*cuts[1:], len(to)]):
                own, times = np.unique(owner[low:high], return_counts=True)  # owners ascend within a bucket
                for column, value in zip(rows, (
                    int(to[low]), all_tokens[low:high].tobytes(), ids[own].tobytes(), sizes[own].astype(np.int32).tobytes(),
                    times.astype(np.int32).tobytes(),
                )):
                    column.append(value)
            kinds = [pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(rows, kinds)], names=["bucket", "tokens", "nodes", "sizes", "times"]
            )

        for batch in batches:
            for text in batch.column(0):
                found = shingles(text.as_py(), k)
                if not len(found) or (node := set_id(found)) in seen:
                    continue
                seen.add(node)
                if len(found) * 100 < percent * (len(found) + 1):
                    continue  # so small that only an equal set is similar, and equal sets are one node
                p = prefix_size(len(found), percent)
                p = min(2 * p - 1, len(found))
                at = np.searchsorted(hot, found).clip(max=max(len(hot) - 1, 0))
                late = hot[at] == found if len(hot) else np.zeros(len(found), bool)
                first = np.concatenate((found[~late], found[late]))[:p] if late.any() else found[:p]
                tokens.append(first)
                nodes.append((node, len(found), len(first)))
            if sum(x[2] for x in nodes) > BLOCK or len(seen) > BLOCK:
                yield packed()
                tokens, nodes, seen = [], [], set()
        if nodes:
            yield packed()

    return arrow_map(df, run, "bucket long, tokens binary, nodes binary, sizes binary, times binary")


def _met(index: DataFrame) -> DataFrame:
    """token, node and n of the index tokens that two nodes or more have."""

    def run(group: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(x.as_py(), kind) for x in group.column(name)])

        tokens = joined("tokens", np.uint64)
        times = joined("times", np.int32)
        nodes = np.repeat(joined("nodes", np.int64), times)
        sizes = np.repeat(joined("sizes", np.int32), times)
        order = np.lexsort((nodes, tokens))
        tokens, nodes, sizes = tokens[order], nodes[order], sizes[order]
        new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])))
        tokens, nodes, sizes = tokens[new], nodes[new], sizes[new]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        lengths = np.diff(np.concatenate((starts, [len(tokens)])))
        many = np.repeat(lengths, lengths) > 1
        return pa.table({"token": tokens[many].astype(np.int64), "node": nodes[many], "n": sizes[many].astype(np.int64)})

    return index.groupBy("bucket").applyInArrow(run, "token long, node long, n long")


def _close(met: DataFrame, percent: int) -> DataFrame:
    """met without the nodes that share too few index tokens to be similar to any node.

    A node has at most as many rows as its set has tokens, so the window is bounded by a document.
    """
    counted = met.withColumn("c", F.count("*").over(Window.partitionBy("node")))
    return counted.where(F.col("c") >= shared_least(F.col("n"), percent)).drop("c")


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """A bit for each node by a part of its hash: BITMAP bits, however many nodes there are."""
    place = F.pmod("node", F.lit(BITMAP))
    words = nodes.select(F.floor(place / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("b"))
    words = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(BITMAP // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def marks(tokens: np.ndarray) -> np.ndarray:
    """The bitmap of a set, as signed numbers of 64 bits: the parity of its tokens in each of as many classes."""
    bits = 64 * len(MARKS)
    counts = np.bincount((tokens >> np.uint64(32)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node, tokens and bitmap of the wanted nodes' sets, one row each.

    The bitmap lets few other sets into the shuffle, and the join takes those out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                nodes, sets = [], []
                for text in batch.column(0).slice(start, SLICE):
                    tokens = shingles(text.as_py(), k)
                    if not len(tokens) or (node := set_id(tokens)) in seen:
                        continue
                    place = node % BITMAP
                    if int(bits[place // 64]) >> (place % 64) & 1:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(tokens)
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                flat = np.concatenate(sets).astype(np.int64) if sets else np.empty(0, np.int64)
                bitmaps = np.array([marks(s) for s in sets], np.int64).reshape(len(sets), len(MARKS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), *map(pa.array, bitmaps.T.copy())],
                    names=["node", "tokens", *MARKS],
                )

    sets = arrow_map(docs.select("text"), run, f"node long, tokens array<long>, {', '.join(f'{m} long' for m in MARKS)}")
    return sets.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def _similar(a: str, b: str, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common * 100 >= (F.size(a) + F.size(b) - common) * percent


def _could(a: str, b: str, percent: int) -> Column:
    """Sizes that the threshold allows."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def similar_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Two rows link if their sets of k-word shingles have a Jaccard similarity of percent / 100 or more, in whole numbers.
    component_id is the least doc_id reachable by links, a row's own without any. A null or empty text, or one
    without words, has no shingle and links with nothing; fewer than k words are one shingle. Rows with equal text
    link. A null doc_id is never a component's id unless all members have none. Rows that share a doc_id may have
    different texts. An empty table gives an empty result; other columns are left out.
    """
    rows, _, linked = _linked(df, id_col, text_col, k, percent)
    members = rows.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = _heads(rows, linked).select("component", F.col("first.doc_id").alias("component_id"))
    out = members.join(heads, "component", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """df with one row of each component of similar_documents, the one with the least id (null last).

    Rows without shingles all stay. Of rows with the same id and the same shingles one stays; rows that only share an
    id are told apart by their texts.
    """
    rows, docs, linked = _linked(df, id_col, text_col, k, percent)
    heads = _heads(rows, linked).select(F.col("first.node").alias("_node"), F.col("first.doc_id").alias("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t.as_py(), k) for t in batch.column(at)]
            nodes = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], names=names)

    at, names = df.columns.index(text_col), [*df.columns, "_node"]
    named = arrow_map(df, run, df.select("*", F.lit(None).cast("long").alias("_node")).schema)
    blank = named.where("_node is null").select(*df.columns)
    # By node and id, so that equal texts of many ids are dealt out; what is left is one id of each component.
    here = (F.col("_node") == F.col("_head")) & F.col(id_col).eqNullSafe(F.col("_id"))
    kept = named.join(heads.withColumnRenamed("_node", "_head"), here)
    once = Window.partitionBy("_node").orderBy(F.xxhash64(text_col))
    kept = kept.withColumn("_n", F.row_number().over(once)).where("_n = 1").select(*df.columns)
    return kept.unionByName(blank)


def _linked(df: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n, node), documents (doc_id, text), and linked nodes with their component."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    described = stored(_described(docs, k), "described")
    rows = described.where("n is not null").select("doc_id", "n", "node")
    size = rows.agg(F.sum("n")).first()[0] or 0
    hot = described.where("token is not null").groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= HOT_GLOBAL)
    listed = [r[0] for r in hot.orderBy(F.desc("c"), "token").limit(HOT_LIST).collect()]  # an order, at most HOT_LIST numbers
    hot_tokens = np.sort(np.array(listed, np.int64).astype(np.uint64))

    index_size = size * 2 * (100 - percent) // 100 + 1
    index = _index(docs.select("text"), k, percent, hot_tokens, max(int(index_size // MEET), 1))
    met = stored(_close(_met(index), percent), "met")

    sets = stored(_sets(docs, met.select("node").distinct(), k), "sets")
    met = stored(_ranked(met), "ranked")
    links = None
    for _ in range(GROUPING):
        pairs = _to_pivots(met if links is None else _apart(met, components(links)), percent)
        found = stored(_compared(pairs, sets, percent), "grouping")
        links = found if links is None else stored(links.union(found), "grouped")
    found = links.union(_search(met, components(links), sets, percent))
    linked = stored(components(found), "linked")
    return rows, docs, linked


def _heads(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """component and its first row: a struct of doc_id and node, the least by id."""
    nodes = rows.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id")).alias("x"))
    nodes = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return nodes.groupBy("component").agg(F.min(F.struct("x.no", "x.doc_id", "node")).alias("first"))


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").where(_similar("ta", "tb", percent)).select("a", "b")


def _ranked(met: DataFrame) -> DataFrame:
    """met with df, the nodes of the token, and score, how central the node is: the mean df of its index tokens."""
    dfs = met.groupBy("token").agg(F.count("*").alias("df"))
    counted = met.join(dfs, "token")
    scores = counted.groupBy("node").agg((F.sum("df") / F.max("n")).alias("score"))
    return counted.join(scores, "node")


def _apart(met: DataFrame, grouped: DataFrame) -> DataFrame:
    """Rows of the tokens whose nodes are in different components, with the component."""
    known = met.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = known.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return known.join(several.select("token"), "token", "left_semi")


def _to_pivots(met: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a node and the pivot that most of its index tokens name, outside its component."""
    met = met if "component" in met.columns else met.withColumn("component", F.col("node"))
    chosen = met.groupBy("token").agg(F.max_by(F.struct("node", "n", "component"), F.struct("score", "node")).alias("p"))
    chosen = chosen.select("token", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.component").alias("other"))
    near = met.join(chosen, "token").where("component <> other").where(_could("n", "pivot_n", percent))
    near = near.groupBy("node", "n", "pivot").count().where(F.col("count") >= shared_least(F.col("n"), percent))
    return near.groupBy("node").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("b")).withColumnRenamed("node", "a")


def _may_be_similar(percent: int) -> Column:
    """Whether a set (q) may be similar to any member of a group (g), by the bits in which it differs from all of them.

    Two bits differ only by a token of one set that the other lacks, and sets of n and m tokens that reach the threshold
    have at most (n + m) * (100 - percent) / (100 + percent) of those.
    """
    agreed = (F.bitwise_not(F.col(f"g.all_{m}").bitwiseXOR(F.col(f"g.any_{m}"))) for m in MARKS)
    differ = [F.bit_count(F.col(f"q.{m}").bitwiseXOR(F.col(f"g.all_{m}")).bitwiseAND(a)) for m, a in zip(MARKS, agreed)]
    return sum(differ[1:], differ[0]) * (100 + percent) <= (F.col("q.n") + F.col("g.high")) * (100 - percent)


def _told_apart(rows: DataFrame) -> DataFrame:
    """rows (node, token) with one of the tokens that the same nodes have: the others would find the same groups again.

    The tokens of a passage that many documents quote have the same nodes. Sets of nodes are told apart by 128 bits.
    """
    mark = F.xxhash64("node")
    held = rows.groupBy("token").agg(
        F.count("*").alias("c"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")
    )
    kept = held.groupBy("c", "x", "y").agg(F.min("token").alias("token")).select("token")
    return rows.join(kept, "token", "left_semi")


def _search(met: DataFrame, grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of grouped, by queries against the groups of the token-group matrix."""
    open_ = _apart(met, grouped)
    sizes = open_.select("node", "component").distinct().groupBy("component").agg(F.count("*").alias("members"))
    open_ = open_.join(sizes, "component")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / PART))
    open_ = stored(open_.withColumn("grp", F.xxhash64("component", part)), "open")
    least = shared_least(F.col("n"), percent)

    # Of two components the smaller one asks. Both sides leave out their last tokens, all but one of those they share.
    tokens = open_.groupBy("node", "n", "grp", "component", "members").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own"), F.max("score").alias("score")
    )
    tokens = stored(tokens.where(F.size("own") >= least).join(sets.select("node", *MARKS), "node"), "queries")
    rare = F.slice("own", F.lit(1), (F.size("own") - least + 1).cast("int"))
    rarer = tokens.select("node", "n", "grp", "component", "members", *MARKS, F.explode(rare).alias("r")).withColumn("token", F.col("r.token"))
    rarer = stored(_told_apart(rarer), "rarer")
    q = rarer.alias("q")
    bits = [f(m).alias(f"{x}_{m}") for m in MARKS for f, x in ((F.bit_and, "all"), (F.bit_or, "any"))]
    g = rarer.groupBy("token", "grp", "component", "members").agg(F.min("n").alias("low"), F.max("n").alias("high"), *bits).alias("g")
    bigger = F.struct("g.members", "g.component") > F.struct("q.members", "q.component")
    fits = (F.col("g.high") * 100 >= F.col("q.n") * percent) & (F.col("g.low") * percent <= F.col("q.n") * 100)
    cells = q.join(g, (F.col("q.token") == F.col("g.token")) & bigger & fits & _may_be_similar(percent)).select("q.node", "g.grp").distinct()
    cells = stored(cells, "cells")

    # The matrix: unions of a group's index tokens, and of its whole sets where those suffice.
    members = tokens.join(cells.select("grp").distinct(), "grp", "left_semi")
    names = F.transform("own", lambda x: x["token"])
    index = members.groupBy("grp").agg(F.array_distinct(F.flatten(F.collect_list(names))).alias("index"))
    asking = tokens.select("node", "n", names.alias("names"))
    near = cells.join(asking, "node").join(index, "grp").where(F.size(F.array_intersect("names", "index")) >= least)
    near = stored(near.select("node", "grp"), "near")
    whole = members.join(near.select("grp").distinct(), "grp", "left_semi").select("grp", "node").join(sets, "node")
    matrix = whole.groupBy("grp").agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"))
    bounded = near.join(sets, "node").join(matrix, "grp")
    opened = bounded.where(F.size(F.array_intersect("tokens", "union")) * 100 >= F.size("tokens") * percent)
    opened = stored(opened.select("node", "grp"), "opened")

    return _to_members(opened, members, sets, percent)


def _to_members(opened: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of queries to members of opened groups, found by what both change in the most central member of the component.

    Let D be the tokens in which a set of n tokens differs from that member's, and slack (100 + percent) * |D| -
    (100 - percent) * n. Two sets differ in |D| + |D'| - 2 * |D and D'| tokens, so they are similar if and only if
    2 * (100 + percent) times the changes they share are at least the sum of their slacks. If the sum of a query's slack
    and the least one of the members is 0 or less, that member is similar, and one link is enough for a component.
    All other similar pairs share a change: any common order has one among the first of each, and the rarest come first.
    """
    twice, few = 2 * (100 + percent), 100 - percent
    held = members.join(opened.select("grp").distinct(), "grp", "left_semi").select("grp", "component", "node", "score")
    central = held.groupBy("component").agg(F.max_by("node", F.struct("score", "node")).alias("node"))
    base = central.join(sets, "node").select("component", F.col("tokens").alias("base"))
    groups = held.select("grp", "component").distinct()
    # A query asks a component once; the group it goes by deals the queries of a large component out.
    asked = opened.join(groups, "grp").groupBy("component", "node").agg(F.min_by("grp", F.xxhash64("node", "grp")).alias("grp"))
    both = asked.select("grp", "node", F.lit(True).alias("asks")).union(held.select("grp", "node", F.lit(False)))
    changes = F.concat(F.array_except("tokens", "base"), F.array_except("base", "tokens"))
    both = both.join(groups.join(base, "component"), "grp").join(sets, "node")
    both = both.select("component", "node", "asks", F.size("tokens").cast("long").alias("n"), changes.alias("changes"))
    m = F.size("changes").cast("long")
    both = stored(both.withColumn("slack", (100 + percent) * m - few * F.col("n")), "changes")

    low = both.where(~F.col("asks")).groupBy("component").agg(F.min(F.struct("slack", "node")).alias("low"))
    asking = both.where("asks").join(low, "component")
    first = asking.select(F.col("node").alias("a"), F.col("low.node").alias("b"))
    asking = asking.where(F.col("slack") + F.col("low.slack") > 0).withColumn("other", F.col("low.slack")).drop("low")
    other = asking.groupBy("component").agg(F.min("slack").alias("other"))
    both = asking.unionByName(both.where(~F.col("asks")).join(other, "component"))
    # Changes that a similar set of the other side shares: by the least slack there, and as many as sizes allow to differ.
    least = F.greatest(F.ceil((F.col("slack") + F.col("other")) / twice), m - F.floor(few * F.col("n") / percent))
    both = both.withColumn("least", least).where(F.col("least") <= m).select("component", "node", "asks", "n", "slack", "least", F.explode("changes").alias("token"))
    both = stored(both, "changed")
    shared = both.groupBy("component", "token").agg(F.count("*").alias("c"), F.min("asks").alias("x"), F.max("asks").alias("y")).where("x <> y")
    both = both.join(shared.select("component", "token", "c"), ["component", "token"])
    both = both.groupBy("component", "node", "asks", "n", "slack", "least").agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("own"))
    m = F.size("own")
    both = both.where(m >= F.col("least")).withColumn("m", m)
    both = both.withColumn("own", F.slice("own", F.lit(1), (m - F.col("least") + 1).cast("int")))
    both = stored(both.select("component", "node", "asks", "n", "slack", "m", F.explode("own.token").alias("token")), "first")
    a, b = both.where("asks").alias("a"), both.where(~F.col("asks")).alias("b")
    same = (F.col("a.component") == F.col("b.component")) & (F.col("a.token") == F.col("b.token"))
    enough = F.col("a.slack") + F.col("b.slack") <= twice * F.least("a.m", "b.m")
    rest = a.join(b, same & enough & _could("a.n", "b.n", percent)).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    return _compared(stored(first.union(rest).distinct(), "asked"), sets, percent)
