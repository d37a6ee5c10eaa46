"""Byte-level BPE encoding with the vocabulary of a tokenizers JSON file.

``tiktoken`` does the ordinary work, several times faster than ``tokenizers`` for the same ids; texts
with a very long piece go to ``tokenizers``, whose merging stays near-linear there.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: Fixed value: the byte-level pre-tokenizer's pattern.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_PIECE = 400
_LONG = re.compile(r"\S{%d}|\s{%d}" % (LONG_PIECE, LONG_PIECE))


def vocabulary_path() -> str:
    """The default vocabulary file; every node has it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Encodes whole texts to ids and back."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_alphabet()
        ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.path, self._slow = path, None
        self._fast = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
        words = {i: w for w, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.size = max(words) + 1
        self.words = [words.get(i, b"") for i in range(self.size)]

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        if _LONG.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self._fast.encode_to_numpy(text, allowed_special="all")

    @property
    def slow(self):  # noqa: ANN201
        if self._slow is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.no_truncation()
            self._slow.no_padding()
        return self._slow

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.words.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)
