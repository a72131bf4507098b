"""Token counts with a whole-token shortcut for a word-end BPE vocabulary."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm.batches import id_and_text, map_texts, utf8

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_whole long"
# Latin letters and numbers beyond ASCII, of which all libraries' versions think alike.
_LETTERS, _NUMBERS = "ªµºÀ-ÖØ-öø-įı-ſ", "²³¹¼-¾"
#: Texts of such characters only: ASCII without the separators that libraries class
#: differently, Latin letters (but for the capital dotted I, whose small form has two
#: characters) and a few signs.  They have their composed form already.  Others take the library.
PLAIN = re.compile(rf"[\t\n\r\x20-\x7E\xA1-\xAC\xAE-\xBF×÷{_LETTERS}–—‘’“”…€]*")
#: The vocabulary's pre-token pattern for plain texts in lower case.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z{_LETTERS}]+|[0-9{_NUMBERS}]|[^\sA-Za-z{_LETTERS}0-9{_NUMBERS}]+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Pre-tokens whose counts a task remembers.
REMEMBERED = 400_000


def library(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that, as a pre-token of their own, are exactly one token.

    Each vocabulary string with a word end is decoded to text and encoded by the library:
    it is kept if normalising and splitting leave it as it is and its merges end in a single
    token.  The result is bounded by the vocabulary.
    """
    tok, kept = library(path), []
    with open(path) as f:
        vocab = json.load(f)["model"]["vocab"]
    visible = byte_letters()
    for token in vocab:
        if not token.endswith("</w>"):
            continue
        try:
            text = bytes(visible[c] for c in token[:-4]).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and PLAIN.fullmatch(text) and tok.normalizer.normalize_str(text) == text:
            kept.append(text)
    return frozenset(t for t, e in zip(kept, tok.encode_batch(kept, add_special_tokens=False), strict=True) if len(e.ids) == 1)


def byte_letters() -> dict[str, int]:
    """The byte of each letter that byte-level vocabularies write for it."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Counter:
    """Counts tokens of texts; one per Python worker."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.tok, self.whole, self.cache = library(path), whole, {}
        with open(path) as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec["added_tokens"]]
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != _PATTERN:
            raise ValueError("the shortcut knows another pre-token pattern than this vocabulary's")

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens, and pre-tokens counted by the shortcut, for each text."""
        total, short = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        left: list[list[str]] = [[] for _ in texts]
        for k, text in enumerate(texts):
            if any(s in text for s in self.special) or not PLAIN.fullmatch(text):
                total[k] = len(self.tok.encode(text, add_special_tokens=False).ids)
                continue
            found = _SPLIT.findall(text.lower())
            left[k] = [x for x in found if x not in self.whole]
            short[k] = len(found) - len(left[k])
        unknown = list({x for xs in left for x in xs if x not in self.cache})
        if len(self.cache) + len(unknown) > REMEMBERED:
            self.cache.clear()
            unknown = list({x for xs in left for x in xs})
        for at in range(0, len(unknown), 20_000):
            self.cache.update(self.merged(unknown[at : at + 20_000]))
        for k, xs in enumerate(left):
            if xs:
                total[k] += sum(map(self.cache.__getitem__, xs))
        return total + short, short

    def merged(self, pretokens: list[str]) -> dict[str, int]:
        """Tokens of each pre-token by its merges."""
        of = self.tok.encode(pretokens, is_pretokenized=True, add_special_tokens=False).word_ids
        return dict(zip(pretokens, np.bincount(np.array(of, np.int64), minlength=len(pretokens)).tolist(), strict=True))


_counters: dict[str, Counter] = {}


def count_tokens(
    docs: DataFrame, path: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of each text, equal to what the library gives for the vocabulary at ``path``.

    ``path`` must be readable on every executor.  Pre-tokens among the proven whole tokens
    count one each (``n_whole``); only the rest is merged.  Texts with special strings or with
    characters beyond plain Latin go to the library as they are.

    A null or empty text has no bytes and no tokens.  Every row gives a row, also with a null
    or repeated id.  Other columns of ``docs`` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        if path not in _counters:
            _counters[path] = Counter(path, shared.value)
        texts = part.column(1)
        total, short = _counters[path].count(texts.to_pylist())
        size = np.diff(utf8(texts)[1])
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(size), pa.array(total), pa.array(total > limit), pa.array(short)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_whole"],
        )

    return map_texts(id_and_text(docs, id_col, text_col), run, SCHEMA)

