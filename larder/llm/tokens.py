"""Token ids of whole texts by a public byte-level vocabulary file."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# The split of the byte-level vocabularies (fixed by their format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(1)
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevelEncoder:
    """Ids as the file's own library gives them: added tokens in a text become their ids."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.added
        }
        self.encoding = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        longest_first = sorted(self.added, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text as unsigned 32-bit integers."""
        if self.parts is None or not any(token in text for token in self.added):
            return self.plain(text)
        pieces = [
            np.array([self.added[part]], "<u4") if i % 2 else self.plain(part)
            for i, part in enumerate(self.parts.split(text))
        ]
        return np.concatenate(pieces)

    def plain(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


@lru_cache(2)
def byte_level(path: str) -> ByteLevelEncoder:
    """One encoder per worker process and file."""
    return ByteLevelEncoder(path)
