"""Token ids of texts as the tokenizers library gives them, through tiktoken where both agree."""

from __future__ import annotations

import base64
import json

import numpy as np
import public_tokenizers
import tiktoken

from gridloom.llm.tokencount import PLAIN, library


class Encoder:
    """Ids by a byte-level vocabulary; ``ranks`` is the same vocabulary as a rank file, or None."""

    def __init__(self, path: str, ranks: str | None):
        self.tok = library(path)
        with open(path) as f:
            self.special = [x["content"] for x in json.load(f)["added_tokens"]]
        self.fast = None
        if ranks:
            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast and PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, ranks: str | None) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = Encoder(path, ranks)
    return _encoders[path, ranks]
