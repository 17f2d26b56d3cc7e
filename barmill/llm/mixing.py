"""Mixing sources to target weights by entropy balancing.

Each source has a token target. Among all rates r of its documents that meet it and stay within the cap, entropy
balancing takes those nearest to one copy each: least sum of r log r - r, subject to sum size * r = target and r <= cap.
The dual has one multiplier for each source and is convex; its solution tilts rates exponentially by size,
r = min(cap, exp(multiplier * size / mean size)). Newton steps on the logarithm of the tokens, kept inside a bracket,
find all multipliers at once; each step is one aggregate over a histogram of sizes. Rates are then rounded into copies so that
running sums in order of size keep in step, and what a source still lacks or has too much is made up by single copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.util import stored

#: Words as the mix counts them.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
STEPS = 60
CLOSE = 1e-5
MAKEUP = 4
#: Documents of one size and source that are ranked together at most, about.
RANKED = 10_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, weight: weights repeat over the sources in order of code points, null last.

    The place of a source is its place in a sorted table of all, counted by partition and not in one task.
    """
    tagged = stored(
        sources.orderBy(F.asc_nulls_last("source")).withColumn("mid", F.monotonically_increasing_id()), "sources"
    ).withColumn("part", F.shiftright("mid", 33))
    counts = tagged.groupBy("part").count()  # a row for each shuffle partition at most
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("part", before.alias("before"))
    place = F.col("before") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    return tagged.join(F.broadcast(offsets), "part").select("source", "source_size", weight.cast("double").alias("weight"))


def targets(weighted: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """weighted with target: share of all tokens by weight, none above cap times its source, the excess dealt again."""
    weighted = stored(weighted, "weights")
    most = F.col("source_size") * cap
    rate = -1.0
    while True:  # each round stops at least one source more; the sums are single values
        full = most <= F.col("weight") * rate
        s = weighted.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, most).otherwise(0.0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        following = (s["all"] * share - s["full"]) / s["open"] if s["open"] else rate
        if following <= rate or not s["open"]:
            break
        rate = following
    return weighted.withColumn("target", F.least(most, F.col("weight") * F.lit(max(rate, 0.0))))


def multipliers(bins: DataFrame, aims: DataFrame, cap: float = CAP, steps: int = STEPS, close: float = CLOSE) -> DataFrame:
    """source and multiplier (null: every document at the cap) by Newton steps on the dual.

    bins: source, size, n. aims: source, source_size, n_docs, target. Only the largest error comes to the driver.
    """
    mean = F.col("source_size") / F.col("n_docs")
    state = aims.where("source_size > 0 and target > 0").select(
        "source", "target", mean.alias("mean"), (F.col("target") >= F.col("source_size") * (cap - 1e-9)).alias("full"),
        F.lit(0.0).alias("m"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
    )
    for _ in range(steps):
        x = F.col("size") / F.col("mean")
        r = F.least(F.lit(cap), F.exp(F.least(F.col("m") * x, F.lit(50.0))))
        keys = ["source", "target", "mean", "full", "m", "low", "high"]
        open_ = F.when(r < cap, r).otherwise(0.0)
        joined = bins.alias("b").join(state.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).drop(bins["source"])
        sums = joined.groupBy(*keys).agg(
            F.sum(F.col("n") * F.col("size") * r).alias("f"), F.sum(F.col("n") * F.col("size") * x * open_).alias("d")
        )
        low = F.when(F.col("f") < F.col("target"), F.col("m")).otherwise(F.col("low"))
        high = F.when(F.col("f") >= F.col("target"), F.col("m")).otherwise(F.col("high"))
        newton = F.col("m") + F.log(F.col("target") / F.col("f")) * F.col("f") / F.col("d")
        inside = (F.col("d") > 0) & (newton > F.coalesce(low, newton - 1)) & (newton < F.coalesce(high, newton + 1))
        beyond = F.when(low.isNull(), high - 1 - F.abs(high)).when(high.isNull(), low + 1 + F.abs(low)).otherwise((low + high) / 2)
        error = F.abs(F.col("f") / F.col("target") - 1)
        done = F.col("full") | (error < close) | (F.coalesce(high - low, F.lit(1.0)) < 1e-13)
        state = stored(sums.select(
            "source", "target", "mean", "full", F.when(done, F.col("m")).when(inside, newton).otherwise(beyond).alias("m"),
            low.alias("low"), high.alias("high"), F.when(done, 0.0).otherwise(error).alias("error"),
        ), "newton")
        if (state.agg(F.max("error")).first()[0] or 0.0) == 0.0:
            break
    return state.select("source", F.when(~F.col("full"), F.col("m")).alias("multiplier"), "mean")


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, row_col: str | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and rate of every row, and its row number if row_col names one.

    A null text has size 0, and texts without words are never taken. Null is a source of its own, the last one. Rows
    with the same id, source and size may swap copies, which makes no difference to the result; with row numbers their
    texts decide first. An empty table gives an empty result. Other columns of df are left out.
    """
    row = [F.col(row_col).alias("row"), F.xxhash64(text_col).alias("hash")] if row_col else []
    docs = stored(df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), *row
    ), "sizes")
    bins = stored(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "bins")
    sizes = bins.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs"))
    sizes = stored(sizes, "totals")
    aims = targets(source_weights(sizes.drop("n_docs"), weights), share, cap)
    aims = stored(null_safe(aims, sizes.select("source", "n_docs"), ["source"]), "aims")
    tilts = multipliers(bins, aims, cap)

    # Parts of a bin: at most about RANKED documents, ordered by size, so that rounding errors cancel.
    parts = F.greatest(F.ceil(F.col("n") / RANKED), F.lit(1))
    binned = null_safe(docs, bins.select("source", "size", parts.alias("parts")), ["source", "size"])
    binned = binned.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.col("parts")))
    groups = null_safe(binned.groupBy("source", "size", "part").agg(F.count("*").alias("n")), tilts, ["source"], "left")
    tilted = F.least(F.lit(cap), F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0))))
    rate = F.when(F.col("mean").isNull() | (F.col("size") == 0), 0.0).otherwise(F.coalesce(tilted, F.lit(cap)))
    groups = groups.withColumn("rate", rate)
    running = F.sum(F.col("n") * F.col("rate")).over(
        Window.partitionBy("source").orderBy(F.desc("size"), "part").rowsBetween(Window.unboundedPreceding, 0)
    )
    groups = groups.withColumn("upto", running)
    start = F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy(F.desc("size"), "part")), F.lit(0.0))
    copies = (F.floor(F.col("upto") + 0.5 + 1e-9) - F.floor(start + 0.5 + 1e-9)).cast("long")
    limit = F.floor(F.col("n") * cap).cast("long")
    copies = F.greatest(F.least(copies, limit), F.lit(0))
    groups = stored(groups.select("source", "size", "part", "n", "rate", copies.alias("k"), limit.alias("limit")), "rounded")
    groups = make_up(groups, aims)

    ranked = null_safe(binned.drop("parts"), groups, ["source", "size", "part"])
    ties = ["hash", "row"] if row_col else []
    place = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("doc_id"), "doc_id", *ties))
    each = (F.floor(F.col("k") / F.col("n")) + F.when(place <= F.col("k") % F.col("n"), 1).otherwise(0)).cast("long")
    out = null_safe(ranked.withColumn("copies", each), aims.select("source", "source_size", "target"), ["source"])
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate",
        *ties[1:],
    )


def make_up(groups: DataFrame, aims: DataFrame, rounds: int = MAKEUP) -> DataFrame:
    """groups with single copies added or taken where a source misses its target by more than one document's size."""
    for _ in range(rounds):
        sums = groups.groupBy("source").agg(F.sum(F.col("k") * F.col("size")).alias("got"))
        lacks = null_safe(aims.select("source", "target"), sums, ["source"]).select(
            "source", (F.col("target") - F.col("got")).alias("lack")
        )
        near = null_safe(groups, lacks, ["source"])
        fits = F.when(F.col("lack") > 0, F.col("k") < F.col("limit")).otherwise(F.col("k") > 0)
        # A copy helps if what is missing afterwards is less than before; the largest such one is taken.
        near = near.where(fits & (F.col("size") > 0) & (F.abs(F.abs("lack") - F.col("size")) < F.abs("lack")))
        gain = F.struct(-F.abs(F.abs("lack") - F.col("size")), "size", "part")
        best = near.groupBy("source").agg(F.max_by(F.struct("size", "part", F.signum("lack").cast("long").alias("by")), gain).alias("b"))
        best = best.select("source", F.col("b.size").alias("size"), F.col("b.part").alias("part"), F.col("b.by").alias("by"))
        moved = null_safe(groups, best, ["source", "size", "part"], "left")
        groups = stored(
            moved.select("source", "size", "part", "n", "rate", (F.col("k") + F.coalesce("by", F.lit(0))).alias("k"), "limit"),
            "madeup",
        )
    return groups


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which a null key meets a null key; keys come once, from the left."""
    named = right.select(*(F.col(c).alias(f"_{c}" if c in keys else c) for c in right.columns))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(named, on, how).drop(*(f"_{k}" for k in keys))


def mixed(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
) -> DataFrame:
    """The mix itself: every row of df as often as the mix takes it, with the columns of df.

    Rows are told apart by numbers of their own, stored with them, so rows that share an id, also the null one, or that are
    equal throughout, come as often as the mix takes each of them.
    """
    row = "_row"
    while row.lower() in (c.lower() for c in df.columns):
        row += "_"
    rows = stored(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    plan = mix(rows, id_col, text_col, source_col, weights, share, cap, row_col=row)
    copies = plan.where("copies > 0").select(F.col("row").alias(row), F.col("copies").cast("int").alias(f"{row}_n"))
    out = rows.join(copies, row)
    return out.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col(f"{row}_n"))).alias(row)).drop(row)
