"""Ids of byte-level BPE files."""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: how byte-level BPE files of this kind cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space in a row that tiktoken is given. Its matcher keeps a step of its stack for each
#: character that the last alternatives of the pattern try, and fails at about a million.
MOST_SPACE = 100_000


def letter_bytes() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts, as the tokenizers library gives them without special tokens around them.

    The merges run in tiktoken, which needs a quarter of the time and gives the same ids. The
    tokenizers library gets texts with very long white space, and those with the string of a
    special token, which becomes that token unless ``plain`` asks for it to be text.
    """

    def __init__(self, path: str, plain: bool = False):
        self.path, self.plain = path, plain
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = letter_bytes()
        self.special = [token["content"] for token in content["added_tokens"]]
        self.bytes = {
            number: bytes(letters[c] for c in token)
            for token, number in content["model"]["vocab"].items()
            if token not in self.special
        }
        self.encoding = tiktoken.Encoding(
            "byte-level",
            pat_str=PATTERN,
            mergeable_ranks={token: number for number, token in self.bytes.items()},
            special_tokens={},
        )

    @cached_property
    def tokenizer(self) -> Tokenizer:
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = self.plain
        return tokenizer

    def _slow(self, text: str) -> bool:
        if not self.plain and any(token in text for token in self.special):
            return True
        return len(text) > MOST_SPACE and _longest_space(text) > MOST_SPACE

    def ids(self, text: str) -> list[int]:
        if self._slow(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text)

    def array(self, text: str) -> np.ndarray:
        return np.array(self.ids(text), np.int64)


def _longest_space(text: str) -> int:
    return max((m.end() - m.start() for m in re.finditer(r"\s+", text)), default=0)
