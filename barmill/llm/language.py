"""Language by rank-order profiles: the out-of-place distance between a text's commonest n-grams and each profile."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.util import arrow_map, slices

LONGEST = 3
#: N-grams in a profile, and the distance of one that a profile lacks.
RANKS = 400
UNKNOWN = "und"
#: A share of the maximal distance below which no text is refused; the share of held-out texts that may lie beyond a bound.
NEAR, REFUSED = 2 / 3, 0.001
#: Steps between 0 and 1 in which distances of held-out texts are counted; bounds are rounded up to one.
STEPS = 10_000
#: Words that held-out texts are cut to as well, so that short texts have bounds of their own.
CUTS = (1, 2, 4, 8, 16)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """All n-grams of up to LONGEST letters as integers; any run of other characters is one blank."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(letters()[codes], codes, 32)
    blank = codes == 32
    codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
    if len(codes) < 3:
        return np.empty(0, np.int64)
    out, grams = [codes[codes != 32]], codes
    for n in range(2, LONGEST + 1):
        grams = (grams[:-1] << 21) | codes[n - 1 :]
        out.append(grams)
    return np.concatenate(out)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(ngrams(text), return_counts=True)


def _added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of several texts, ascending, and their counts."""
    grams, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    n = np.zeros(len(grams), np.int64)
    np.add.at(n, back, np.concatenate([f[1] for f in found]))
    return grams, n


@dataclass(frozen=True)
class Profiles:
    """Ranks of all profiles' n-grams: a row for each language, RANKS where a profile lacks one."""

    langs: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how much nearer the best profile is than the next, 0 to 1; und without any letter."""
        return self.measured(text)[:2]

    def measured(self, text: str | None) -> tuple[str, float, float, int]:
        """Language, score, distance of the best profile as a share of the maximal one, and n-grams compared."""
        grams, counts = counted(text or "")
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0, 1.0, 0
        order = np.lexsort((grams, -counts))[:RANKS]
        at = np.searchsorted(self.grams, grams[order]).clip(max=len(self.grams) - 1)
        known = self.grams[at] == grams[order]
        apart = np.abs(self.ranks[:, at] - np.arange(len(order)))
        apart = np.where(known, np.where(self.ranks[:, at] == RANKS, RANKS, apart), RANKS)
        distance = apart.sum(axis=1)
        best = int(distance.argmin())
        others = np.delete(distance, best)
        rest = others.min() if len(others) else RANKS * len(order)
        score = float((rest - distance[best]) / rest) if rest else 0.0
        return self.langs[best], score, float(distance[best] / (RANKS * len(order))), len(order)


def learn(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> Profiles:
    """Profiles of all languages of df, from all of their texts; null languages teach nothing."""
    rows = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            by: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                by.setdefault(lang, []).append(counted(text))  # distinct ones: all of a batch take 24 bytes a letter, several times
            for lang, found in by.items():
                gram, n = _added(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"]
                )

    counts = arrow_map(rows, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < RANKS)
    found = top.select("lang", "gram", "rank").collect()  # RANKS rows a language
    langs, grams = sorted({r.lang for r in found}), np.array(sorted({r.gram for r in found}), np.int64)
    ranks = np.full((len(langs), len(grams)), RANKS, np.int64)
    for r in found:
        ranks[langs.index(r.lang), np.searchsorted(grams, r.gram)] = r.rank
    return Profiles(tuple(langs), grams, ranks)


def _size(n: int) -> int:
    """Texts of about as many n-grams have one bound."""
    return n.bit_length()


def bounds(df: DataFrame, profiles: Profiles) -> dict[int, float]:
    """By size of a text, the share of the maximal distance beyond which it is in none of the languages.

    Set on all held-out documents labelled with a learned language, whole and cut to their first words: at most REFUSED
    of a size lie beyond. A size without any has NEAR, and none has less.
    """
    rows = df.where(held_out("doc_id") & F.col("lang").isin(list(profiles.langs)) & F.col("text").isNotNull()).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: Counter[tuple[int, int]] = Counter()
            for text in batch.column(0).to_pylist():
                words = text.split(None, max(CUTS))
                for form in (text, *(" ".join(words[:k]) for k in CUTS if k < len(words))):
                    *_, apart, n = profiles.measured(form)
                    if n:
                        out[_size(n), ceil(apart * STEPS)] += 1
            columns = [pa.array([k[0] for k in out], pa.int32()), pa.array([k[1] for k in out], pa.int32()), pa.array(out.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "step", "n"])

    steps = arrow_map(rows, run, "size int, step int, n long").groupBy("size", "step").agg(F.sum("n").alias("n"))
    found = steps.groupBy("size").agg(F.percentile("step", F.lit(1 - REFUSED), F.col("n")).alias("b"))  # at most STEPS rows a size
    return {r["size"]: max(NEAR, r["b"] / STEPS) for r in found.collect()}  # a row for each power of two up to RANKS


def identify(df: DataFrame, profiles: Profiles, text_col: str = "text", bounds: dict[int, float] | None = None) -> DataFrame:
    """df with lang_pred and score, which replace columns of these names.

    A null or empty text, or one without a letter, is und with score 0, and so is all if nothing was learned. With
    bounds, so is a text whose distance is beyond that of its size. Ties go to the first language by name. Repeated
    rows and nulls in other columns pass through.
    """

    def said_of(text: str | None) -> tuple[str, float]:
        lang, score, apart, n = profiles.measured(text)
        return (UNKNOWN, 0.0) if bounds is not None and apart > bounds.get(_size(n), NEAR) else (lang, score)

    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    at = kept.index(text_col)
    rows = df.select(*kept)
    schema = rows.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            said = [said_of(t) for t in batch.column(at).to_pylist()]
            new = [pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*kept, "lang_pred", "score"])

    return arrow_map(rows, run, schema)


def held_out(id_col: str):
    """Rows that profiles are tested on; those without an id are neither tested on nor learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def taught(df: DataFrame) -> Profiles:
    """Profiles from the rows of documents that are not held out."""
    return learn(df.where(~held_out("doc_id") & F.col("doc_id").isNotNull()), "doc_id", "text", "lang")
