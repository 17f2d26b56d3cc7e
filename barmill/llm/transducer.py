"""BPE as a streaming transducer, and its inverse.

Encoding reads pieces of text. A split (word, number, run of signs or blanks) is final once the character after it is
known. Its bytes go through RunTransducer, which emits tokens while they come; a split longer than LONG is not awaited, and
the tokens of short ones are remembered. The look-ahead comes from the merge list. Two tokens are compatible if merging
their joint bytes gives just these two, and a sequence is the BPE encoding of its bytes if and only if all its
neighbours are compatible. So every prefix of the bytes has one last token, a cut of an encoding is the encoding of
the cut bytes, and the token that covers a byte read next starts within the longest token's length. Tokens common to the
encodings of all prefixes ending in that window can never change: a look-ahead of the longest token's length is enough.

Decoding turns ids into bytes and feeds a UTF-8 state machine, which holds back at most three bytes.
"""

from __future__ import annotations

import codecs
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.bpe import REACH, ByteBpe, load
from barmill.llm.util import arrow_map, slices

PIECE = 1 << 16
#: Characters from which a split is streamed.
LONG = 1 << 12
#: Characters of a split whose tokens are remembered, so that memory stays bounded.
SHORT = 1 << 8
#: Splits in each of two memories: a full one becomes the older one, from which splits in use come back.
WORDS = 200_000
#: Pairs of tokens whose compatibility is remembered, and bytes after which a long split emits what is stable.
PAIRS, STEP = 1 << 18, 1 << 10
#: Runs that a split may consist of; a run of blanks gives its last one to the next split.
RUNS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]


class Rules:
    """What the merge list says of single tokens and of pairs, remembered as it is asked; and which tokens end where."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for word, token in bpe.ids.items():
            self.automaton.add_word(word.decode("latin-1"), (token, len(word)))
        self.automaton.make_automaton()

    def made_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens that a token's last merge joins; the token itself, twice, for a byte; None if no merges lead to it.

        The earliest merge goes first, of equal ones the leftmost.
        """
        if token not in self.halves:
            word, rank = self.bpe.bytes[token], self.bpe.ids.get
            parts = [word[k : k + 1] for k in range(len(word))]
            while len(parts) > 2:
                found = [(r, k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank(a + b)) is not None]
                if not found:
                    break
                at = min(found)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            pair = tuple(map(rank, parts))
            self.halves[token] = (token, token) if len(pair) == 1 else pair if len(pair) == 2 else None
        return self.halves[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the joint bytes of two tokens merge into just these two.

        Both are taken apart again, the latest merge first (of one kind the right one, as it was made later). Between
        two steps the parts that meet at the border would have merged if their merge came before the one last undone.
        """
        if (known := self.pairs.get(a << 20 | b)) is not None:
            return known
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        key, text, rank = a << 20 | b, self.bpe.bytes, self.bpe.ids.get
        undone = len(text) << 1
        while True:
            joint = rank(text[a] + text[b])
            if joint is not None and joint < undone:
                self.pairs[key] = False
                return False
            left, right = len(text[a]) > 1, len(text[b]) > 1
            if not left and not right:
                self.pairs[key] = True
                return True
            if left and (not right or a > b):
                undone, a = a, self.made_of(a)[1]
            else:
                undone, b = b + 1, self.made_of(b)[0]

    def whole(self, token: int) -> bool:
        """Whether the bytes of a token merge into it."""
        return self.made_of(token) is not None


class RunTransducer:
    """Tokens of one split whose bytes come bit by bit; memory is bounded by the window of undecided tokens."""

    def __init__(self, rules: Rules):
        self.rules, self.ends = rules, None
        self.at = self.stable = 0
        self.last: list[tuple[int, int]] = [(-1, 0)]  # last token, and where it starts, of the prefix that ends at stable and of each longer one

    def step(self, data: bytes) -> None:
        """Find the last token of every prefix that ends in data: of the tokens ending there the one that fits."""
        text = data.decode("latin-1")
        if self.ends is None:
            self.ends = self.rules.automaton.iter(text)
        else:
            self.ends.set(text)
        last, stable, known, at = self.last, self.stable, self.rules.pairs.get, self.at
        for end, (token, n) in self.ends:
            if end < at:
                continue  # that prefix has its token
            start = end + 1 - n
            if start:
                if start < stable:
                    continue
                before = last[start - stable][0]
                if (fits := known(before << 20 | token)) is None:
                    fits = self.rules.compatible(before, token)
            else:
                fits = self.rules.whole(token)
            if fits:
                at = end + 1
                last.append((token, start))
        self.at += len(data)
        if at != self.at:
            raise AssertionError("every byte is a token")

    def path(self, end: int) -> list[int]:
        out = []
        while end > self.stable:
            token, end = self.last[end - self.stable]
            out.append(token)
        return out[::-1]

    def feed(self, data: bytes) -> Iterator[int]:
        for k in range(0, len(data), STEP):
            self.step(data[k : k + STEP])
            yield from self.settle()

    def settle(self) -> Iterator[int]:
        """Emit what all prefixes that the next token may start after have in common."""
        live = set(range(max(self.stable, self.at - self.rules.bpe.longest), self.at + 1))
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(self.last[top - self.stable][1])
        common = live.pop()
        if common > self.stable:
            out = self.path(common)
            del self.last[: common - self.stable]
            self.stable = common
            yield from out

    def whole(self, data: bytes) -> list[int]:
        """Tokens of a split that is known as a whole."""
        self.step(data)
        return self.path(self.at)

    def finish(self) -> list[int]:
        return self.path(self.at)


class Encoder:
    """Text in pieces to tokens in pieces."""

    def __init__(self, bpe: ByteBpe, long: int = LONG):
        self.bpe, self.long, self.rules = bpe, long, Rules(bpe)
        # Tokens as packed numbers of 32 bits: small, and nothing that the garbage collector goes through.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def of_word(self, word: str) -> bytes:
        out = self.older.get(word) or array("i", RunTransducer(self.rules).whole(word.encode("utf-8", "surrogatepass"))).tobytes()
        if len(word) <= SHORT:
            if len(self.known) >= WORDS:
                self.known, self.older = {}, self.known
            self.known[word] = out
        return out

    def words(self, words: list[str]) -> list[int]:
        known, own, out = self.known.get, self.of_word, array("i")
        out.frombytes(b"".join([known(w) or own(w) for w in words]))
        return out.tolist()

    def closed(self, text: str) -> Iterator[list[int]]:
        """Tokens of a text that nothing follows, in pieces."""
        at = 0
        for m in self.bpe.special.finditer(text) if self.bpe.special else ():
            yield from self.plain(text[at : m.start()])
            yield [self.bpe.specials[m[0]]]
            at = m.end()
        yield from self.plain(text[at:])

    def plain(self, text: str) -> Iterator[list[int]]:
        """Tokens of a stretch without special tokens."""
        yield from self.open(text[k : k + PIECE] for k in range(0, len(text), PIECE))

    def open(self, pieces: Iterable[str]) -> Iterator[list[int]]:
        """The transducer: pieces without special tokens to tokens, as soon as they are stable."""
        buffer, run, kind = "", None, None
        for piece in pieces:
            buffer += piece
            if run is not None:
                buffer, ended, ids = self.on(run, kind, buffer, final=False)
                yield ids
                if not ended:
                    continue
                run = None
            # Splits follow one another without gaps; the last ones may still change.
            words, at = self.bpe.pattern.findall(buffer), len(buffer)
            while words and (at == len(buffer) or at - len(words[-1]) + REACH > len(buffer)):
                at -= len(words.pop())
            yield self.words(words)
            buffer = buffer[at:]
            if len(buffer) > self.long + 2:
                skip = 1 if buffer[0] == " " and not buffer[1].isspace() else 0
                kind = next(k for k in RUNS if k.match(buffer, skip))
                run = RunTransducer(self.rules)
                head, buffer = buffer[:skip], buffer[skip:]
                first = [*run.feed(head.encode())]
                buffer, ended, ids = self.on(run, kind, buffer, final=False)
                yield first + ids
                if ended:
                    run = None
        if run is not None:
            buffer, _, ids = self.on(run, kind, buffer, final=True)
            yield ids
        yield self.words(self.bpe.pattern.findall(buffer))

    def on(self, run: RunTransducer, kind, buffer: str, final: bool) -> tuple[str, bool, list[int]]:
        """Go on with a split under way: the text left, whether the split has ended, and stable tokens."""
        m = kind.match(buffer)
        end = m.end() if m else 0
        ended = final or end < len(buffer)
        if kind is RUNS[3] and (not ended or end < len(buffer)):
            end = max(end - 1, 0)  # the last blank before a word belongs to the word
        ids = [*run.feed(buffer[:end].encode("utf-8", "surrogatepass"))]
        if ended:
            ids += run.finish()
        return buffer[end:], ended, ids


class Decoder:
    """Ids to text; bytes of an unfinished character wait, broken ones become U+FFFD."""

    def __init__(self, bpe: ByteBpe):
        self.bytes = bpe.bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        return self.state.decode(b"".join(map(self.bytes.__getitem__, ids)), final)


def _rows(df: DataFrame, id_col: str, value: str) -> tuple[DataFrame, str]:
    return df.select(F.col(id_col).alias("doc_id"), F.col(value).alias("value")), df.schema[id_col].dataType.simpleString()


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row; a null or empty text has no ids. Other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(path))
        for batch in slices(batches):
            ids = [list(chain.from_iterable(encoder.closed(t or ""))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows, kind = _rows(df, id_col, text_col)
    return arrow_map(rows, run, f"doc_id {kind}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids give the empty text. Other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches):
            texts = [Decoder(bpe).feed(ids or (), final=True) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows, kind = _rows(df, id_col, ids_col)
    return arrow_map(rows, run, f"doc_id {kind}, text string")


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids (decimal, joined by commas) and of the text decoded from them.

    Both machines run in step, so no row is held as a whole list of ids. A null text is the empty one; nulls in
    doc_id, repeated rows and empty tables pass through; other columns of df are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        encoder = Encoder(bpe)
        decimal = {i: b"%d" % i for i in bpe.bytes}
        for batch in slices(batches):
            found = [[], [], []]
            for text in batch.column(1).to_pylist():
                n, ids, out, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(bpe)
                for part in encoder.closed(text or ""):
                    if part:
                        ids.update((b"," if n else b"") + b",".join(map(decimal.__getitem__, part)))
                        n += len(part)
                        out.update(decoder.feed(part).encode())
                out.update(decoder.feed((), final=True).encode())
                for column, value in zip(found, (n, ids.hexdigest(), out.hexdigest())):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.string())
            columns = [batch.column(0), *(pa.array(v, k) for v, k in zip(found, kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows, kind = _rows(df, id_col, text_col)
    return arrow_map(rows, run, f"doc_id {kind}, {DIGESTS}")


def tokenised(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """df with n_tokens, ids (array of int) and lossless, whether the ids decode to the text; a null text has none.

    Columns of these names are replaced; rows with nulls in other columns and repeated rows pass through.
    """
    new = ("n_tokens", "ids", "lossless")
    rows = df.select(*(c for c in df.columns if c not in new))
    names, at = [*rows.columns, *new], rows.columns.index(text_col)
    none = F.lit(None)
    kinds = (none.cast("long"), none.cast("array<int>"), none.cast("boolean"))
    schema = rows.select("*", *(k.alias(c) for c, k in zip(new, kinds))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        encoder = Encoder(bpe)
        for batch in slices(batches):
            ids, lossless = [], []
            for text in (t or "" for t in batch.column(at).to_pylist()):
                found, decoder, same, done = array("i"), Decoder(bpe), True, 0
                for part in encoder.closed(text):
                    found.extend(part)
                    said = decoder.feed(part)
                    same = same and text.startswith(said, done)
                    done += len(said)
                ids.append(np.frombuffer(found, np.int32))
                lossless.append(same and not decoder.feed((), final=True) and done == len(text))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            sizes = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, lists, pa.array(lossless)], names=names)

    return arrow_map(rows, run, schema)
