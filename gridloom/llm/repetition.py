"""Quality rules by repetition: suffix arrays with longest-common-prefix intervals."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gridloom.llm.batches import SPACE, U64, Words, bounded_batches, chunks, id_and_text, map_texts, mix, per_text

WINDOW = 8


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict; shares in percent."""

    min_words: int = 20
    max_repeat_words_pct: int = 30
    min_run_words: int = 4
    max_covered_pct: int = 40
    max_longest_words: int = 100


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_chars long, longest_repeat_words long, n_intervals long"
)


def repeated_spans(words: np.ndarray, doc: np.ndarray, least: int = WINDOW):
    """Suffixes of each text that share ``least`` words or more with another one of it.

    The suffix array of all texts of a chunk by prefix doubling: a suffix's rank is the place
    of its group, and only groups of two or more are sorted again.  Ranks after each doubling
    tell the longest common prefix of neighbours.  Returns the suffixes in their order, each
    one's longest prefix shared with a neighbour (words), and that shared with the next one.
    """
    n = len(words)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, none
    order = np.argsort(mix(words + doc.astype(np.uint64) * U64(0x2545F4914F6CDD1D)))
    key = words[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (doc[order[1:]] != doc[order[:-1]])])
    size = np.diff(np.r_[first, n])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, size)
    pos = order[np.repeat(size, size) > 1]
    levels, h, repeated = [], 1, none
    while len(pos):
        if h <= least:
            repeated = pos
        levels.append((h, rank.copy()))
        ahead = np.minimum(pos + h, n - 1)
        second = np.where((pos + h < n) & (doc[ahead] == doc[pos]), rank[ahead], -1)
        order = np.lexsort((second, rank[pos]))
        pos, second = pos[order], second[order]
        old = rank[pos]
        group = np.r_[True, old[1:] != old[:-1]]
        fresh = group | np.r_[True, second[1:] != second[:-1]]
        place = np.arange(len(pos))
        begin, at = np.flatnonzero(group), np.flatnonzero(fresh)
        within = place[at] - np.repeat(begin, np.diff(np.r_[begin, len(pos)]))[at]
        size = np.diff(np.r_[at, len(pos)])
        rank[pos] = np.repeat(old[at] + within, size)
        pos = pos[np.repeat(size, size) > 1]
        h *= 2
    repeated = repeated[np.argsort(rank[repeated])]
    a, b = repeated[:-1], repeated[1:]
    shared = np.zeros(len(a), np.int64)
    for h, rank in reversed(levels):
        i, j = a + shared, b + shared
        ok = (i < n) & (j < n)
        ok[ok] = (rank[i[ok]] == rank[j[ok]]) & (i[ok] != j[ok])
        shared[ok] += h
    longest = np.maximum(np.r_[0, shared], np.r_[shared, 0])[: len(repeated)]
    # between two suffixes that are left out, shared prefixes are short as well
    keep = np.flatnonzero(longest >= least)
    return repeated[keep], longest[keep], shared[keep[keep < len(shared)]]


def duplicate_lines(texts: list[str]) -> list[int]:
    """Lines with a word that equal an earlier line, for each text."""
    blank = " \t\n\v\f\r"
    out = []
    for text in texts:
        lines = [x for x in text.split("\n") if x.strip(blank)]
        out.append(len(lines) - len(set(lines)))
    return out


_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])


def measure(part: pa.RecordBatch, rules: RepetitionRules) -> pa.RecordBatch:
    texts = part.column(1)
    w = Words(texts, ~SPACE)
    counts = w.counts()
    # bytes that begin a code point, before each byte
    points = np.r_[0, np.cumsum((w.data & 0xC0) != 0x80)]
    chars = points[w.end] - points[w.start]
    symbols = np.r_[0, np.cumsum(_SYMBOL[w.data])]
    hashes = w.hashes()
    pos, longest, shared = repeated_spans(hashes, w.doc, min(rules.min_run_words, WINDOW))
    n = len(hashes)

    def covered(length, least: int) -> np.ndarray:
        long = longest >= least
        delta = np.bincount(pos[long], minlength=n + 1) - np.bincount((pos + length)[long], minlength=n + 1)
        return np.cumsum(delta)[:n] > 0

    by_window, by_span = covered(WINDOW, WINDOW), covered(longest, rules.min_run_words)
    best = np.zeros(len(counts), np.int64)
    np.maximum.at(best, w.doc[pos], np.where(longest >= rules.min_run_words, longest, 0))
    # an interval begins where the shared prefix grows beyond that of the neighbour before
    grows = np.flatnonzero((shared >= rules.min_run_words) & (shared > np.r_[0, shared[:-1]])) if len(shared) else pos
    intervals = np.bincount(w.doc[pos[grows]], minlength=len(counts)) if len(pos) else np.zeros(len(counts), np.int64)
    word_chars, repeat = per_text(counts, chars), per_text(counts, by_window)
    span_chars = per_text(counts, np.where(by_span, chars, 0))
    failed = (counts < rules.min_words) | (100 * repeat > rules.max_repeat_words_pct * counts)
    kept = ~failed & (100 * span_chars <= rules.max_covered_pct * word_chars) & (best <= rules.max_longest_words)
    lines = np.zeros(len(counts), np.int64)
    many = np.flatnonzero(pc.match_substring(texts.fill_null(""), "\n").to_numpy(zero_copy_only=False))
    lines[many] = duplicate_lines(texts.take(pa.array(many)).to_pylist())
    out = [part.column(0), counts, word_chars, symbols[w.at[1:]] - symbols[w.at[:-1]], lines, repeat]
    out += [failed, kept, span_chars, best, intervals]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out], names=names)


def score_repetition(
    docs: DataFrame, rules: RepetitionRules | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Repetition measures and the verdict for each row of ``docs``.

    Words are runs of other characters than ASCII white space.  The longest-common-prefix
    intervals of a text's suffix array give its maximal repeated runs of ``min_run_words``
    words or more; ``covered_chars`` counts the characters of words inside their union and
    ``longest_repeat_words`` the longest one (its two places may overlap).  A document fails
    the base rules with fewer than ``min_words`` words or more than 30 % of words in repeated
    8-word windows, and the method's verdict beyond the covered share or the longest repeat;
    its runs are shorter than the windows, so short phrases said again and again fail too.

    A null or empty text has no words and fails.  Rows with a null or repeated id are judged
    like others, one result each.  Other columns of ``docs`` are not read.  A single text must
    fit in a task's memory, at about 100 bytes a byte.
    """
    rules = rules or RepetitionRules()
    return map_texts(id_and_text(docs, id_col, text_col), lambda part: measure(part, rules), SCHEMA)


def filter_repetition(docs: DataFrame, rules: RepetitionRules | None = None) -> DataFrame:
    """The rows of ``docs`` that ``score_repetition`` keeps, with all their columns.

    Whole rows pass through the verdict, so no join on the id is needed and null or repeated
    ids do no harm.
    """
    rules = rules or RepetitionRules()
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                pair = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), part.column("text")], ["doc_id", "text"])
                yield part.filter(measure(pair, rules).column("kept"))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)
