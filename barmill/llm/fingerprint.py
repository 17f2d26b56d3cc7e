"""Fingerprints of documents by a homomorphic hash of the multiset of their paragraphs.

Every paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors modulo
2**32 in each lane. So the order of paragraphs does not count, and inserting or deleting one adds or subtracts its vector.
The vector has two parts: EQUAL lanes, the SHA-256 digest of the whole paragraph, which decide equality, and ALIKE lanes that
are themselves sums over the paragraph's chunks of CHUNK words, each chunk adding 0 or 1 to a lane by a bit of its hash.
Less half the number of chunks they are a random projection of the multiset of chunks; their cosine is the likeness.

The EQUAL lanes are disjoint slices of 256 bits, so each is as good as an independent hash of the paragraph.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.util import stored, whole

EQUAL = 8
ALIKE = 64
CHUNK = 4
MASK = (1 << 32) - 1
#: Blocks in which rows are put in order.
BLOCKS = 256


def paragraphs(text: Column) -> Column:
    """Paragraphs are lines that are not blank; of a text without one, the text itself."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    return F.when(F.trim(F.translate(text, "\n", "")) != "", lines).otherwise(F.array(text))


def _plus(a: Column, b: Column) -> Column:
    return (a + b).bitwiseAND(F.lit(MASK))


def vector(text: Column) -> Column:
    """A struct of e0.. (EQUAL lanes), a0.. (pairs of ALIKE lanes, 32 bits each) and n, the number of chunks."""
    # A digest's 16 hexadecimal digits at a time make a long of two lanes.
    digests = F.transform(F.transform(paragraphs(text), lambda p: F.sha2(p, 256)), lambda h: F.array(*(
        F.conv(F.substring(h, 1 + 16 * k, 16), 16, -10).cast("long") for k in range(EQUAL // 2)
    )))
    equal = F.aggregate(
        digests,
        F.struct(*(F.lit(0).cast("long").alias(f"e{k}") for k in range(EQUAL))),
        lambda acc, d: F.struct(*(
            _plus(acc[f"e{k}"], F.shiftrightunsigned(d[k // 2], 32 * (1 - k % 2)).bitwiseAND(F.lit(MASK))).alias(f"e{k}")
            for k in range(EQUAL)
        )),
    )
    # Chunks begin anew in each paragraph, so the vector is a sum over paragraphs.
    chunks = F.regexp_extract_all(text, F.lit(rf"(?:[^\s]+[^\S\n]*){{1,{CHUNK}}}"), F.lit(0))
    hashes = F.transform(chunks, lambda c: F.xxhash64(F.rtrim(c)))
    bit = F.lit((1 << 32) + 1)
    alike = F.aggregate(
        hashes,
        F.struct(*(F.lit(0).cast("long").alias(f"a{k}") for k in range(ALIKE // 2)), F.lit(0).cast("long").alias("n")),
        lambda acc, h: F.struct(
            *((acc[f"a{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(bit)).alias(f"a{k}") for k in range(ALIKE // 2)),
            (acc["n"] + 1).alias("n"),
        ),
    )
    return F.struct(equal.alias("equal"), alike.alias("alike"))


def lanes(v: Column) -> Column:
    """All lanes of a vector, chunks first."""
    pairs = [v["alike"][f"a{k}"] for k in range(ALIKE // 2)]
    halves = [h for p in pairs for h in (p.bitwiseAND(F.lit(MASK)), F.shiftrightunsigned(p, 32))]
    return F.array(v["alike"]["n"], *(v["equal"][f"e{k}"] for k in range(EQUAL)), *halves)


def text_form(lane: Column) -> Column:
    """Lanes as hexadecimal digits, eight for each."""
    return F.array_join(F.transform(lane, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def added(a: Column, b: Column) -> Column:
    """Lanes after paragraphs with the lanes b are inserted into a document with the lanes a."""
    return F.zip_with(a, b, lambda x, y: _plus(x, y))


def removed(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(1 << 32)))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two lane arrays' chunk parts, at least 0; 1 for equal ones, 0 if just one has no chunk."""
    def signed(x: Column) -> Column:
        return F.transform(F.slice(x, 2 + EQUAL, ALIKE), lambda v: v * 2.0 - x[0])

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)

    dot = total(F.zip_with(signed(a), signed(b), lambda x, y: x * y))
    norm = F.sqrt(total(F.transform(signed(a), lambda v: v * v)) * total(F.transform(signed(b), lambda v: v * v)))
    cosine = F.when(norm > 0, F.greatest(F.least(dot / norm, F.lit(1.0)), F.lit(0.0))).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(cosine)


def with_lanes(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """df with the lanes of a text column; the vector is a column of its own so that it is computed once."""
    return df.withColumn("_vector", vector(F.col(text_col))).withColumn(name, lanes(F.col("_vector"))).drop("_vector")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, lanes and fingerprint of every row; a null text is the empty one.

    Equal texts, and texts with the same paragraphs in another order, have equal fingerprints.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    out = with_lanes(rows, "text", "lanes")
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), "lanes", text_form(F.col("lanes")).alias("fingerprint"))


def following(ids: DataFrame) -> DataFrame:
    """ids (doc_id, half) with the next doc_id in ascending order, null first; the last one is followed by the first.

    Rows are put in order within blocks between quantiles, and a block's last row meets the next block's first: no task
    gets all rows.
    """
    cuts = ids.agg(F.percentile_approx("doc_id", [k / BLOCKS for k in range(1, BLOCKS)], 10_000)).first()[0] or []
    block = reduce(lambda a, c: a + (F.col("doc_id") > c).cast("int"), sorted(set(cuts)), F.lit(0))
    rows = ids.withColumn("block", F.coalesce(block, F.lit(-1)))
    inside = Window.partitionBy("block").orderBy(F.asc_nulls_first("doc_id"))
    rows = rows.withColumn("next_id", F.lead("doc_id").over(inside)).withColumn("is_last", F.lead("block").over(inside).isNull())
    firsts = rows.groupBy("block").agg(F.min("doc_id").alias("first_id"))  # BLOCKS + 1 rows at most
    row = Window.orderBy("block")
    begin = F.first("first_id").over(row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    has_next = F.lead("block").over(row).isNotNull()
    wraps = firsts.select("block", F.when(has_next, F.lead("first_id").over(row)).otherwise(begin).alias("after"))
    rows = rows.join(F.broadcast(wraps), "block")
    return rows.select("doc_id", "half", F.when(F.col("is_last"), F.col("after")).otherwise(F.col("next_id")).alias("next_id"))


def with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    Of rows with the same id, all have the same next document: the one with the next id, and of several with that, the
    least text. A null id is the lowest. A single id is followed by itself. A null text is the empty one.
    """
    text = whole(F.col(text_col))
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    ids = stored(rows.groupBy("doc_id").agg(F.max(half).alias("half")), "ids")
    links = stored(following(ids), "following")

    # Of the next document only as much of the text moves as the edit needs, and its lanes. Keys are never null, so that
    # the join and the choice among rows of one id share a shuffle.
    def key(name: str) -> list[Column]:
        return [F.coalesce(F.col(name), F.lit(0)).alias("_key"), F.col(name).isNull().alias("_null")]

    wanted = links.select(*key("next_id"), F.col("doc_id").alias("_before"), F.col("half").alias("_half"))
    heads = rows.select(*key("doc_id"), "text").join(wanted, ["_key", "_null"]).drop("_key", "_null")
    heads = with_lanes(heads, "text", "next_lanes").select(
        *key("_before"), F.expr("substring(text, 1, _half)").alias("head"), "next_lanes"
    )
    once = Window.partitionBy("_key", "_null").orderBy("head", "next_lanes")
    heads = heads.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    own = with_lanes(rows, "text", "own").select(
        *key("doc_id"), "doc_id", F.length("text").cast("long").alias("n_chars"), "own",
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))").alias("kept"),
    )
    both = own.join(heads, ["_key", "_null"])
    edited = F.concat("kept", F.expr("substring(head, 1, cast(floor(n_chars / 2) as int))"))
    both = with_lanes(both.withColumn("edited", edited), "edited", "changed")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), text_form(F.col("own")).alias("fingerprint"),
        text_form(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_lanes")).alias("near_next"),
    )
