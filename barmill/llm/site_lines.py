"""Boilerplate lines of a site: lines on more than a share of the pages of their host are dropped.

A long line that unrelated texts share is a repeated passage however rare it is: it does not come about twice by chance,
and the pages of a large host would hide it. Copies and near copies of one text are not unrelated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm.licenses import grams
from barmill.llm.util import stored

#: Share of a host's pages beyond which a line is boilerplate, and pages that must hold it in any case.
RATIO = 0.1
PAGES = 3
#: A line of more words is long. Sketches of the rest of a text, and words in what they are drawn from.
LONG = 50
SKETCHES, CHUNK = 4, 3
#: Rows up to which a table is sent to all tasks; a larger one is joined by a shuffle, with the same result.
SENT = 200_000


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(df: DataFrame, host: Column, text: Column, ratio: float = RATIO, pages: int = PAGES) -> DataFrame:
    """host, line (64-bit hash of the trimmed line), n and total of every boilerplate line.

    A line counts once for each page. Blank lines, null texts and null hosts do not count.
    """
    rows = df.select(host.alias("host"), text.alias("text")).where("host is not null")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    counts = (
        rows.select("host", F.explode(F.array_distinct(F.transform(lines, _key))).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= pages)
    )
    totals = rows.groupBy("host").agg(F.count("*").alias("total"))
    return counts.join(totals, "host").where(F.col("n") > F.col("total") * ratio)


def drop_boilerplate(
    df: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO, pages: int = PAGES, keep_whole: bool = True
) -> DataFrame:
    """df with the boilerplate lines taken out of text_col, n_lines (before) and n_dropped.

    With keep_whole a page of which nothing but blank lines would be left keeps its text, for corpora whose copied
    documents are told from boilerplate by a later step; without it such a page, an error page say, loses its lines.
    Null texts and pages without a host stay as they are; repeated rows count as pages. A line's place in the text
    and blank lines stay. Columns of df named n_lines or n_dropped are replaced, others pass through.
    """
    kept = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    rows = df.select(*kept, host.alias("_host"))
    found = boilerplate(rows, F.col("_host"), F.col(text_col), ratio, pages)
    # The list of a host is short: shares of pages add up to a page's lines, so it has at most lines / ratio members.
    lists = found.groupBy("host").agg(F.collect_list("line").alias("_drop"))

    # A host with more pages than a task should take is dealt to as many tasks as a shuffle has, its list with it.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hosts = rows.where("_host is not null").groupBy("_host").count()
    all_pages = hosts.agg(F.sum("count")).first()[0] or 0
    hot = [r[0] for r in hosts.where(F.col("count") > max(all_pages / spread, 1000)).collect()]  # fewer than spread
    salt = F.when(F.col("_host").isin(hot), F.pmod(F.xxhash64(text_col), F.lit(spread))).otherwise(F.lit(0))
    salts = F.when(F.col("host").isin(hot), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    left = rows.withColumn("_salt", salt.cast("int"))
    right = lists.select(F.col("host").alias("_host"), "_drop", F.explode(salts).alias("_salt"))

    lines = F.split(text_col, "\n")
    clean = F.filter(lines, lambda x: ~F.array_contains("_drop", _key(x)))
    out = left.join(right, ["_host", "_salt"], "left").withColumn("_clean", F.when(F.col("_drop").isNotNull(), clean))
    out = out.withColumn("_clean", F.when(~empty_of("_clean") if keep_whole else F.col("_clean").isNotNull(), F.col("_clean")).otherwise(lines))
    return out.select(
        *(F.array_join("_clean", "\n").alias(c) if c == text_col else F.col(c) for c in kept),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size("_clean"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def _long_lines(text: Column) -> Column:
    def is_long(line: Column) -> Column:
        return (F.length(line) > 2 * LONG) & (F.size(F.split(F.trim(line), r"\s+")) > LONG)

    return F.array_distinct(F.transform(F.filter(F.split(text, "\n"), is_long), _key))


def _sketched(held: DataFrame) -> DataFrame:
    """_text, line and s: least hashes of the word chunks of text without line; near copies share one, unrelated texts hardly ever.

    Words and chunks are columns of their own, so that each is computed once a row and not wherever it is used.
    """
    rest = F.trim(F.array_join(F.filter(F.split("text", "\n"), lambda x: _key(x) != F.col("line")), " "))
    words = held.select("_text", "line", F.split(F.lower(rest), r"\s+").alias("words"))
    few = F.array(F.array_join("words", " "))
    chunks = words.select("_text", "line", F.when(F.size("words") < CHUNK, few).otherwise(grams(F.col("words"), CHUNK)).alias("chunks"))
    least = (F.array_min(F.transform("chunks", lambda x: F.xxhash64(x, F.lit(k)))) for k in range(SKETCHES))
    return chunks.select("_text", "line", F.array(*least).alias("s"))


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SENT else df


def passages(df: DataFrame, text_col: str = "text", pages: int = PAGES, ratio: float = RATIO) -> DataFrame:
    """_text (64-bit hash of a text) and _long, the keys of its long lines that stand in unrelated texts.

    A line's unrelated texts are those that share no sketch with another holder of the line, and one for all that do.
    They must be at least pages, and a ratio of all different texts that hold it, since of many near copies a few
    seem unrelated.
    """
    texts = df.select(F.xxhash64(text_col).alias("_text"), F.col(text_col).alias("text"))
    pairs = texts.select("_text", F.explode(_long_lines(F.col("text"))).alias("line")).distinct()
    often = pairs.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= pages)
    held = stored(pairs.join(often, "line"), "passages")
    each = _sketched(texts.join(_sent(held), "_text")).distinct()
    each = each.select("_text", "line", F.posexplode("s").alias("k", "s"))
    single = each.groupBy("line", "k", "s").agg(F.count("*").alias("n"), F.min("_text").alias("_text")).where("n = 1")
    alone = single.groupBy("line", "_text").count().where(F.col("count") == SKETCHES).groupBy("line").agg(F.count("*").alias("alone"))
    found = alone.join(held.select("line", "n").distinct(), "line")
    unrelated = F.col("alone") + (F.col("n") > F.col("alone")).cast("int")
    found = found.where((unrelated >= pages) & (unrelated >= F.col("n") * ratio)).select("line")
    lists = held.join(found, "line").groupBy("_text").agg(F.collect_set("line").alias("_long"))
    return stored(lists, "passages-of-texts")


def drop_passages(df: DataFrame, text_col: str = "text", pages: int = PAGES, ratio: float = RATIO) -> DataFrame:
    """df with the long lines taken out of text_col that unrelated texts share, whatever their host.

    A text of which nothing would be left stays as it is. Columns and rows pass through.
    """
    lists = passages(df, text_col, pages, ratio)
    lines = F.split(text_col, "\n")
    out = df.withColumn("_text", F.xxhash64(text_col)).join(_sent(lists), "_text", "left")
    out = out.withColumn("_clean", F.filter(lines, lambda x: ~F.array_contains("_long", _key(x))))
    text = F.when(F.col("_long").isNotNull() & ~empty_of("_clean"), F.array_join("_clean", "\n")).otherwise(F.col(text_col))
    return out.select(*(text.alias(c) if c == text_col else F.col(c) for c in df.columns))


def empty_of(lines: str) -> Column:
    return F.forall(lines, lambda x: F.trim(x) == "")


#: What is no text of a page, and tags that end a line.
HIDDEN = [r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?s)<!--.*?-->"]
BLOCKS = r"(?i)</?(html|head|body|title|nav|ul|ol|li|div|article|section|header|footer|main|h[1-6]|p|br|table|tr)\b[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"


def page_lines(html: Column) -> Column:
    """The text of a page with a line for each block."""
    for hidden in HIDDEN:
        html = F.regexp_replace(html, hidden, " ")
    html = F.regexp_replace(F.regexp_replace(html, BLOCKS, "\n"), r"<[^>]*>", "")
    return F.trim(F.regexp_replace(html, r"[ \t]*\n[ \t\n]*", "\n"))


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)
