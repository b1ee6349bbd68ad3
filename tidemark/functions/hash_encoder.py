"""A numpy encoder that counts hashed tokens, to stand where a downloaded model would."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np


def load_hash_encoder(size: int = 64) -> Callable[[list[str]], np.ndarray]:
    token = re.compile(r"\w+", re.ASCII)
    known: dict[str, int] = {}

    def bucket(word: str) -> int:
        if word not in known:
            if len(known) > 100_000:
                known.clear()
            known[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % size
        return known[word]

    def encode(sentences: list[str]) -> np.ndarray:
        vectors = np.zeros((len(sentences), size))
        for row, sentence in zip(vectors, sentences):
            for word in token.findall(sentence.lower()):
                row[bucket(word)] += 1
        return vectors

    return encode
