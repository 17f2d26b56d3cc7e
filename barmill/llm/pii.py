"""Personal data by base patterns and by boosted trees over the spans that wide generators propose.

Base spans follow fixed patterns and checks and always stay. Generators propose overlapping spans of looser forms: mail
addresses in words ("a at b dot c"), addresses and numbers in other groupings, phones without a plus. Trees fitted on
features of format and context give each a probability, and a threshold for each kind, set on texts held out from the
fit, selects those that are added; of overlapping ones the likeliest stays, and none that overlaps a base span.

There are no labelled spans. Positive examples are base spans of all texts, as they stand and rewritten into the loose
forms within their own context; negative ones are other candidates that fail the checks or stand as dates,
versions or amounts, and made-up amounts, dates, versions, hashes and counts put into the same contexts. Other candidates
may be personal data in a loose form, so they teach nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm import boost
from barmill.llm.util import arrow_map, slices, stored

KINDS = ("email", "ip", "card", "phone")
#: Base patterns.
BASE = {
    "email": re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+"),  # its name is what stands before it in NAME
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),  # a run of digits is tried once
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
WIDE = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64}(?:\s?@\s?[A-Za-z0-9-]{1,63}(?:\s?\.\s?[A-Za-z0-9-]{2,63}){1,4}"
        r"|(?:\s?[\[(]\s?at\s?[\])]\s?|\sat\s)[A-Za-z0-9-]{1,63}(?:(?:\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s)[A-Za-z0-9-]{2,63}){1,4})"
    ),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ ._/-]{0,3}[0-9]{2,6}){2,5}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z])(?:\+|00|\()?[0-9](?:[ ().\-/]{0,2}[0-9]){6,16}(?![0-9A-Za-z])"),
}
PRECISION = 0.99
#: Steps between 0 and 1 in which probabilities of held-out examples are counted; least examples to fit and to test.
STEPS, FITTED, TESTED = 10_000, 20, 5
WORDS = ("mail", "contact", "write", "phone", "call", "tel", "fax", "mobile", "card", "visa", "pay", "ip", "host", "server")
NEAR = 40
#: Last labels of common hosts, and words of two letters that are no country's label in running text.
LABELS = frozenset("com org net edu gov mil int info biz name pro io dev app co online site shop xyz tech blog cloud news email example".split())
SMALL = frozenset("am an as at be by do he if in is it me my no of on or so to up us we".split())
LAST = re.compile(r"([A-Za-z0-9-]+)[\])]?$")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def holds(kind: str, found: str) -> bool:
    """Whether a match of a base pattern passes its check."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        digits = digits_of(found)
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits_of(found)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) in order; matches that fail are dropped without another try."""
    spans, done = [], 0
    for m in BASE["email"].finditer(text) if "@" in text else ():
        start = m.start()
        while start > done and text[start - 1] in NAME:
            start -= 1
        if start < m.start():
            spans.append((start, 0, m.end()))
            done = m.end()
    for place, kind in enumerate(KINDS):
        if kind != "email" and (kind != "phone" or "+" in text):
            spans += [(m.start(), place, m.end()) for m in BASE[kind].finditer(text) if holds(kind, m[0])]
    return sorted(spans)


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Candidates of all kinds; they may overlap one another and base spans."""
    out = []
    for place, kind in enumerate(KINDS):
        if kind == "email" and "@" not in text and "dot" not in text:
            continue
        out += [(m.start(), place, m.end()) for m in WIDE[kind].finditer(text)]
    return out


FEATURES = 19 + len(WORDS)


def host_label(span: str) -> bool:
    """Whether a span ends in what hosts end in: a common label, or two letters that are no small word."""
    found = LAST.search(span)
    label = found[1].lower() if found else ""
    return label in LABELS or (len(label) == 2 and label.isalpha() and label not in SMALL)


def features(text: str, start: int, place: int, end: int) -> list[float]:
    """Format of a span and its context; the same for every kind, since each kind has trees of its own."""
    span = text[start:end]
    digits = digits_of(span)
    groups = re.findall("[0-9]+", span)
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    near = f"{before} {after}".lower()
    tail = span.rsplit(".", 1)[-1] if "." in span else span.split()[-1]
    return [
        len(span), len(digits), len(digits) / len(span), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), luhn(digits) if digits else 0, all(int(g[-4:]) <= 255 for g in groups) if groups else 0,
        span.count(" "), span.count("-"), span.count("."), sum(c in "()[]" for c in span), "@" in span,
        bool(re.search(r"[\[(]\s?(?:at|dot)\s?[\])]|\sdot\s", span)), len(tail), span[0] in "+0(",
        before[-1:].isalnum() or after[:1].isalnum(), before.rstrip()[-1:] in ("=", "$", "#", "v", "€", "£"),
        host_label(span), *(float(w in near) for w in WORDS),
    ]


def loose_forms(kind: str, span: str) -> list[str]:
    """A base span in forms that the base patterns don't take."""
    if kind == "email":
        name, host = span.split("@", 1)
        host = host.replace(".", " dot ")
        return [f"{name} at {host}", f"{name} [at] {host.replace(' dot ', ' [dot] ')}", f"{name}(at){host.replace(' dot ', '(dot)')}"]
    if kind == "ip":
        return [span.replace(".", "[.]"), span.replace(".", " . ")]
    digits = digits_of(span)
    if kind == "card":
        parts = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [".".join(parts), "  ".join(parts), "/".join(parts)]
    d = digits[-10:]
    return [f"{d[:3]}-{d[3:6]}-{d[6:]}", f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"00{digits}", f"00 {digits[:2]} {digits[2:]}"]


def decoys(kind: str, span: str, near: str = "") -> list[str]:
    """What looks alike and is none: drawn from the digits of a hash of the span, so that reruns agree.

    Words of the text nearby, and small ones, stand around "at" and "dot" as in prose.
    """
    n = int(hashlib.sha256(span.encode()).hexdigest(), 16)
    a, b, c, d = n % 9000 + 1000, n // 7 % 90 + 10, n // 11 % 90 + 10, n // 13 % 900 + 100
    if kind == "email":
        own = [w for w in re.findall("[A-Za-z]{2,12}", near) if not host_label(w)] or ["noon", "home", "then"]
        pick = [own[n // k % len(own)] for k in (3, 5, 17, 19)]
        prose = [f"{pick[0]} at {pick[1]} dot {pick[2]}", f"{pick[3]} at {pick[0]} dot {sorted(SMALL)[n % len(SMALL)]}"]
        return [f"look at the{a} dot", f"{a} at {b} dot {c}{d}", f"meet at noon{b}.then", "was at home.and", *prose]
    if kind == "ip":
        return [f"{a % 10}.{b}.{c}.{d + 300}", f"{d} . {d} . {a} . {b}", f"{a % 1000 + 256}.{d + 256}.1.0"]
    if kind == "card":
        bad = str(n)[:16]
        bad = bad[:-1] + str((int(bad[-1]) + 1 + (luhn(bad[:-1] + str((int(bad[-1]) + 1) % 10)))) % 10)
        return [bad, f"{a}-{b}-{c} {b}:{c}:{b}", f"{a}{a}.{d}{d}", f"{a}/{a}/{a}"]
    return [f"{a}-{b}-{c}", f"{a}{d}{b}", f"{b}.{c}.{a}", f"{a}-{b}-{c} {b}:{c}", f"{d}{d}{d}{d}{d}", str(n)[:7], str(n)[:12]]


@dataclass(frozen=True)
class Model:
    trees: dict[str, boost.Trees]
    thresholds: dict[str, float]

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and all spans with those that the trees add."""
        base = base_spans(text)
        if not re.search("[0-9@]|dot", text):
            return base, base
        taken = list(base)
        loose = [s for s in proposals(text) if not _meets(s, base)]
        scored = []
        for place, kind in enumerate(KINDS):
            own = [s for s in loose if s[1] == place and plausible(kind, text[s[0] : s[2]])]
            if own and self.thresholds.get(kind, 1.1) <= 1:
                p = self.trees[kind].probability(np.array([features(text, *s) for s in own], float))
                scored += [(-q, s) for q, s in zip(p, own) if q >= self.thresholds[kind]]
        for _, span in sorted(scored):
            if not _meets(span, taken):
                taken.append(span)
        return base, sorted(taken)


def _meets(span: tuple[int, int, int], others: list[tuple[int, int, int]]) -> bool:
    return any(span[0] < o[2] and o[0] < span[2] for o in others)


def plausible(kind: str, span: str) -> bool:
    """Checks that hold for any form of a kind; a span that fails them is no candidate."""
    digits = digits_of(span)
    if kind == "ip":
        return all(int(g) <= 255 for g in re.findall("[0-9]+", span))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


#: What no mail address ends with, how dates stand, a dot in words, and what stands before versions and amounts.
NO_DOMAIN = re.compile(r"(?:[0-9-]|[^A-Za-z][A-Za-z])$")
DATE = re.compile(r"(?:19|20)[0-9]{2}([-/.])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])(?![0-9])|(?:[0-2]?[0-9]|3[01])([-/.])(?:[0-2]?[0-9]|3[01])\2(?:19|20)[0-9]{2}(?![0-9])")
SPOKEN = re.compile(r"\sdot\s")
NUMBERED = re.compile(r"(?:(?<![a-z])(?:v|ver|version|release|build)[.:]?|[$€£])\s?$", re.I)


def refuted(text: str, start: int, place: int, end: int) -> bool:
    """Whether a candidate surely is none of its kind: it fails the checks, or stands as a date, version or amount."""
    kind, span = KINDS[place], text[start:end]
    if kind == "email":
        return bool(NO_DOMAIN.search(span)) or (bool(SPOKEN.search(span)) and not host_label(span))
    return not plausible(kind, span) or bool(DATE.match(span)) or bool(NUMBERED.search(text[max(0, start - NEAR) : start]))


def examples(text: str) -> Iterator[tuple[str, list[float], bool]]:
    """Kind, features and label of what a text teaches."""
    if not re.search("[0-9@]|dot", text):
        return
    base = base_spans(text)
    for start, place, end in base:
        kind, span = KINDS[place], text[start:end]
        before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
        for label, forms in ((True, [span, *loose_forms(kind, span)]), (False, decoys(kind, span, before + " " + after))):
            for form in forms:
                at = len(before)
                yield kind, features(before + form + after, at, place, at + len(form)), label
    for s in proposals(text):
        if not _meets(s, base) and refuted(text, *s):
            yield KINDS[s[1]], features(text, *s), False


def taught(df: DataFrame, text_col: str = "text") -> DataFrame:
    """kind, test, y, f and n: how many examples of all texts have this label and these features.

    A text's examples are all for the test, or all for the fit, by its own hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: Counter[tuple] = Counter()
            for text in batch.column(0).to_pylist():
                test = zlib.crc32(text.encode("utf-8", "surrogatepass")) % 4 == 3
                out.update((kind, test, label, tuple(map(float, f))) for kind, f, label in examples(text))
            kinds = (pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.float64()))
            columns = [pa.array([k[i] for k in out], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out.values(), pa.int64())], names=["kind", "test", "y", "f", "n"])

    texts = df.select(F.col(text_col).alias("text")).where("text is not null")
    found = arrow_map(texts, run, "kind string, test boolean, y boolean, f array<double>, n long")
    return found.groupBy("kind", "test", "y", "f").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, text_col: str = "text") -> Model:
    """Trees and thresholds from the examples of all texts; a kind without enough examples adds no spans."""
    rows = stored(taught(df, text_col), "examples")
    n = {(r.kind, r.test): r.n for r in rows.where("y").groupBy("kind", "test").agg(F.sum("n").alias("n")).collect()}
    able = [k for k in KINDS if n.get((k, False), 0) >= FITTED and n.get((k, True), 0) >= TESTED]
    thresholds = dict.fromkeys(KINDS, 1.1)
    if not able:
        return Model({}, thresholds)
    trees = boost.grow(rows.where(F.col("kind").isin(able) & ~F.col("test")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, x = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            step = np.zeros(len(kinds), np.int64)
            for kind in able:
                own = np.flatnonzero(kinds == kind)
                if len(own):
                    step[own] = trees[kind].probability(np.array([x[k] for k in own])) * STEPS
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(step), *batch.columns[2:]], names=["kind", "step", "y", "n"])

    held = rows.where(F.col("kind").isin(able) & F.col("test")).select("kind", "f", "y", "n")
    steps = arrow_map(held, run, "kind string, step long, y boolean, n long").groupBy("kind", "step", "y").agg(F.sum("n").alias("n"))
    found = steps.orderBy("kind", "step", "y").collect()  # at most two rows a kind and step
    for kind in able:
        p, y, n = (np.array(v, float) for v in zip(*((r.step / STEPS, r.y, r.n) for r in found if r.kind == kind)))
        thresholds[kind] = boost.threshold(p, y, PRECISION, n)
    return Model(trees, thresholds)


def find(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans (base and added) of every row.

    Spans are kind:start:end in code points, the end exclusive, by start and then kind, joined by commas. A null
    or empty text has none. Repeated rows and null ids pass through; other columns are left out.
    """

    def said(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[p]}:{s}:{e}" for s, p, e in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans = [], []
            for text in batch.column(1).to_pylist():
                base, every = model.spans(text or "")
                for place, column in enumerate(counts):
                    column.append(sum(s[1] == place for s in base))
                digests.append(hashlib.sha256(said(base).encode()).hexdigest())
                spans.append(said(every))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return arrow_map(rows, run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """text with each span replaced by its kind; overlapping spans are one."""
    out, at = [], 0
    for start, place, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[place]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
