"""Token counts by public tokenizers, loaded once for each Python worker."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

#: Default folder and file; both are parameters of the operators.
FOLDER, FILE = os.environ.get("TURNMILL_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern of this byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizer:
    """Counts and byte ends of tokens."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for raw, i in ranks.items():
            self.widths[i] = len(raw)

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def count(self, text: str) -> int:
        return len(self.encode(text))

    def ends(self, text: str) -> np.ndarray:
        """Byte position after each token."""
        return np.cumsum(self.widths[np.asarray(self.encode(text), dtype=np.int64)])


@lru_cache(4)
def tokenizer(path: str | None = None) -> Tokenizer:
    return Tokenizer(path or os.path.join(FOLDER, FILE))
