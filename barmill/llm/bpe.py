"""Byte-level BPE vocabularies read from a public tokenizer file, shared by counting and by the transducer."""

from __future__ import annotations

import json
from functools import cached_property, lru_cache

import regex
import tiktoken

#: Fixed value: how byte-level tokenizers split text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters after a split's start that its choice may look at.
REACH = 4
#: Words kept with their tokens by one Python worker; the memory starts anew when it is full.
WORDS = 50_000


def printable_bytes() -> dict[str, int]:
    """The characters by which vocabulary files write bytes: printable ones stand for themselves."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = (b for b in range(256) if b not in set(shown))
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Tokens by bytes, in order of merging, and the special tokens that the library finds inside texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        back = printable_bytes()
        self.ids = {bytes(back[c] for c in word): i for word, i in spec["model"]["vocab"].items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.bytes = {i: word for word, i in self.ids.items()}
        self.bytes |= {i: text.encode() for text, i in self.specials.items()}
        merged = ["".join(pair) if isinstance(pair, list) else pair.replace(" ", "") for pair in spec["model"]["merges"]]
        if any(spec["model"]["vocab"][word] != 256 + k for k, word in enumerate(merged)):
            raise ValueError(f"{path}: token ids do not follow the order of merging")
        self.longest = max(map(len, self.ids))
        self.pattern = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None

    @cached_property
    def _core(self):
        """Only for counting: the transducer has no use for it."""
        return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=self.ids, special_tokens={})._core_bpe

    def merge(self, word: bytes) -> list[int]:
        """Tokens of one split: the earliest merge first, until none applies."""
        return self._core.encode_single_piece(word)

    def held_back(self, text: str) -> int:
        """Length of the longest end of text that may be the start of a special token."""
        reach = max(map(len, self.specials), default=1) - 1
        tail = text[-reach:] if reach else ""
        return max((k for s in self.specials for k in range(1, len(s)) if tail.endswith(s[:k])), default=0)


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)
