"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found in the text as it is.  Three transducers then rewrite disguises
(look-alike characters, spelled digits, "at" and "dot"), each keeping for every character it
writes the span it was read from; identifiers found in the rewritten text are mapped back.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.batches import bounded_batches, chunks, id_and_text, map_texts

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match takes all digits at its end, so none begins behind a digit; this keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = (2 * int(c) for c in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(x - 9 * (x > 9) for x in doubled)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Local parts are read backwards from each @, so no run of letters is read twice."""
    out, free = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, m.end()))
                free = m.end()
    return out


def identifiers(text: str) -> list[tuple[int, int, str]]:
    """Plain identifiers, leftmost and without overlap in each kind, as (start, end, kind)."""
    out = [(s, e, "email") for s, e in emails(text)]
    if _DIGIT.search(text):
        out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(_octet(x) for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
    if "+" in text:
        out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def _octet(x: str) -> bool:
    x = x.lstrip("0")
    return len(x) <= 3 and int(x or 0) <= 255


@dataclass
class Tape:
    """Text with the source span of each character."""

    text: str
    start: list[int] | range
    end: list[int] | range

    @classmethod
    def of(cls, text: str) -> Tape:
        return cls(text, range(len(text)), range(1, len(text) + 1))

    def rewrite(self, pieces: list[tuple[int, int, str]]) -> Tape:
        """Replace the spans of ``pieces`` (in order, apart) by their texts."""
        text, start, end, at = [], [], [], 0
        for a, b, new in pieces:
            text += [self.text[at:a], new]
            start += [*self.start[at:a], *[self.start[a]] * len(new)]
            end += [*self.end[at:a], *[self.end[b - 1]] * len(new)]
            at = b
        text.append(self.text[at:])
        return Tape("".join(text), [*start, *self.start[at:]], [*end, *self.end[at:]])


# Look-alikes of Latin letters and signs: Cyrillic, Greek, signs; left out: what NFKC knows.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјкморстухԁԛԝһ"
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυχ"
        "‐‑‒–—−"
        "۔。·•∙",
        "ABESIJKMHOPCTYXaesijkmopctyxdqwh"
        "ABEZHIKMNOPTYXaiknoptux"
        "------"
        ".....",
        strict=True,
    )
)
_INVISIBLE = "­​‌‍⁠﻿"


@lru_cache(maxsize=4096)
def _plain(c: str) -> str | None:
    """What a disguised character stands for, or None if it is none."""
    if c in _INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c.isspace() and c not in "\n\r\x0b\x0c\x1c\x1d\x1e\x85  ":
        return " "
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(d)
    new = unicodedata.normalize("NFKC", c)
    return new if len(new) == 1 and new.isascii() else None


# Latin letters with accents and typographic quotes are no disguise, unless they are look-alikes.
_UNUSUAL = re.compile("[^\x00-\x7f¡-¬®-¶¸-ɏ̀-ͯ‘-‟…€一-鿿぀-ヿ가-힣]")


_ENTITY = re.compile(r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});|&(?:commat|period|plus|nbsp|hyphen|lpar|rpar|lsqb|rsqb);")


def entities(tape: Tape) -> Tape:
    found = [(*m.span(), new) for m in _ENTITY.finditer(tape.text) if len(new := html.unescape(m[0])) == 1]
    return tape.rewrite(found) if found else tape


def characters(tape: Tape) -> Tape:
    found = [(m.start(), m.end(), new) for m in _UNUSUAL.finditer(tape.text) if (new := _plain(m[0])) is not None]
    return tape.rewrite(found) if found else tape


# Digit words: English, German, Spanish, French.
DIGIT_WORDS = {
    w: str(d)
    for d, words in enumerate(
        (
            "zero oh null cero zéro", "one eins uno un", "two zwei dos deux", "three drei tres trois",
            "four vier cuatro quatre", "five fünf cinco cinq", "six sechs seis", "seven sieben siete sept",
            "eight acht ocho huit", "nine neun nueve neuf",
        )
    )
    for w in words.split()
}
_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_GAP = r"(?:[ \t]*(?:[-,/()\[\]][ \t]*){1,3}|[ \t]+)"
_UNIT = rf"(?:{_WORD}(?!\w)|[0-9]{{1,4}}(?![0-9A-Za-z]))"
_POINT = r"[ \t]*(?:\.|[ \t](?:dot|point|punkt|punto)[ \t])[ \t]*"
#: Digit words, and short numbers among them, with at most a sign or a dot between two.
_SPELLED = re.compile(rf"(?<!\w){_UNIT}(?:(?:{_GAP}|{_POINT}){_UNIT}){{3,}}", re.IGNORECASE)
_PART = re.compile(rf"(?<![\w]){_WORD}(?!\w)|[0-9]+|dot|point|punkt|punto|\.|[-,/()\[\] \t]+", re.IGNORECASE)
_PLUS = re.compile(r"(?<!\w)(?:(?:plus|más|mas)[ \t]+|\+[ \t]*)[(\[]?[ \t]*$", re.IGNORECASE)
_LEAST_WORDS = 4


def spelled_digits(tape: Tape) -> Tape:
    """Digits for digit words, for the identifier check to judge.

    A run of 10 to 15 digits that is no card reads as a phone number if four are words.
    """
    found = []
    for m in _SPELLED.finditer(tape.text):
        own, words = [], 0
        for x in _PART.finditer(tape.text, m.start(), m.end()):
            word = x[0].lower()
            words += word in DIGIT_WORDS
            new = DIGIT_WORDS.get(word) or (word if word.isdigit() else "." if word.strip(" \t-,/()[]") else "")
            own.append((*x.span(), new))
        digits = "".join(new for _, _, new in own)
        # a few words beside a plain identifier, such as the article "un", are none of its digits
        if not words or (words < _LEAST_WORDS and identifiers(tape.text[max(0, m.start() - 12) : m.end()])):
            continue
        if p := _PLUS.search(tape.text, max(0, m.start() - 12), m.start()):
            own.insert(0, (*p.span(), "+"))
        # articles such as "un" repeat in ordinary text
        elif words >= _LEAST_WORDS and len(set(digits)) > 1 and "." not in digits and 10 <= len(digits) <= 15 and not (len(digits) >= 14 and luhn(digits)):
            own[0] = (*own[0][:2], "+" + own[0][2])
        found += own
    return tape.rewrite(found) if found else tape


_AT = r"(?:at|arroba|@)"
_DOT = r"(?:dot|punto|punkt|point|\.)"
_BRACKETED = re.compile(
    rf"\s{{0,3}}[\[({{<]\s{{0,3}}(?:({_AT})|{_DOT})\s{{0,3}}[\])}}>]\s{{0,3}}", re.IGNORECASE
)
# Bare words only in a whole address: with both at and dot as words any last label will do, else
# a common top-level domain ends it.  "Point" is too common behind "at" to count as such a dot.
_TOP = "com|org|net|edu|gov|info|io|co|dev|ai|me|eu|de|fr|es|uk|us|ch|at|it|nl"
_SEP_DOT = r"(?:[ \t]{1,3}(?:dot|punto|punkt|point)[ \t]{1,3}|\.)"
_BARE = re.compile(
    rf"(?<![\w.%+-])[A-Za-z0-9_%+-]{{1,64}}(?:{_SEP_DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,3}}(?P<at>[ \t]{{1,3}}(?:at|arroba)[ \t]{{1,3}}|@)"
    rf"[A-Za-z0-9-]{{1,64}}(?:{_SEP_DOT}[A-Za-z0-9-]{{1,64}}){{0,3}}{_SEP_DOT}(?:{_TOP})(?![\w-])",
    re.IGNORECASE,
)
_BOTH = re.compile(
    rf"(?<![\w.%+-])[A-Za-z0-9_%+-]{{1,64}}(?:{_SEP_DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,3}}(?P<at>[ \t]{{1,3}}(?:at|(?P<sure>arroba))[ \t]{{1,3}})"
    r"(?!(?:the|an?|this|that|each|every|any|some|one|which|what|his|her|its|my|our|your|their)[ \t])"
    rf"[A-Za-z0-9-]{{1,64}}(?:{_SEP_DOT}[A-Za-z0-9-]{{1,64}}){{0,3}}[ \t]{{1,3}}(?:dot|punto|punkt|(?(sure)point|dot))[ \t]{{1,3}}[A-Za-z]{{2,24}}(?![\w-])",
    re.IGNORECASE,
)
#: The same with spaces around the signs themselves.
_SPACED = re.compile(
    rf"(?<![\w.%+-])[A-Za-z0-9._%+-]{{1,64}}(?P<at>[ \t]{{1,3}}@[ \t]{{1,3}})[A-Za-z0-9-]{{1,64}}"
    rf"(?:[ \t]{{0,3}}\.[ \t]{{0,3}}[A-Za-z0-9-]{{1,64}}){{0,3}}[ \t]{{0,3}}\.[ \t]{{0,3}}(?:{_TOP})(?![\w-])",
    re.IGNORECASE,
)
_SPACED_DOT = re.compile(r"[ \t]{0,3}\.[ \t]{0,3}")
_BARE_DOT = re.compile(r"[ \t]{1,3}(?:dot|punto|punkt|point)[ \t]{1,3}", re.IGNORECASE)
_MAY_BE_BARE = re.compile(r"[ \t](?:at|arroba|dot|punto|punkt|point)[ \t]", re.IGNORECASE)


def at_and_dot(tape: Tape) -> Tape:
    found = [(m.start(), m.end(), "@" if m[1] else ".") for m in _BRACKETED.finditer(tape.text)]
    tape = tape.rewrite(found) if found else tape
    found = []
    if _MAY_BE_BARE.search(tape.text):
        for near in _MAY_BE_BARE.finditer(tape.text):
            # an address spans at most so many characters around one of its separators
            span = max(0, near.start() - 300), min(len(tape.text), near.end() + 300)
            for m in (*_BARE.finditer(tape.text, *span), *_BOTH.finditer(tape.text, *span)):
                at = m.span("at")
                own = [(*at, "@")] if at[1] - at[0] > 1 else []
                own += [(*d.span(), ".") for d in _BARE_DOT.finditer(tape.text, *m.span()) if d.start() != at[0]]
                found += own
    for near in re.finditer(r"[ \t]@[ \t]", tape.text):
        for m in _SPACED.finditer(tape.text, max(0, near.start() - 70), min(len(tape.text), near.end() + 300)):
            found.append((*m.span("at"), "@"))
            found += [(*d.span(), ".") for d in _SPACED_DOT.finditer(tape.text, m.end("at"), m.end()) if d.end() - d.start() > 1]
    found = sorted(set(found))
    found = [x for k, x in enumerate(found) if not k or x[0] >= found[k - 1][1]]
    return tape.rewrite(found) if found else tape


_MAYBE_SPELLED = re.compile(rf"(?<!\w){_WORD}(?!\w)(?:{_GAP}|{_POINT})(?:{_WORD}(?!\w)|[0-9])|[0-9](?:{_GAP}|{_POINT}){_WORD}(?!\w)", re.IGNORECASE)
_MAYBE_AT = re.compile(r"[\[({<]\s{0,3}(?:at|arroba|@|dot|punto|punkt|point|\.)\s{0,3}[\])}>]|[ \t](?:at|arroba|@)[ \t]", re.IGNORECASE)


def may_be_disguised(text: str) -> bool:
    """Whether a transducer may find something; each is named here."""
    unusual = not text.isascii() and _UNUSUAL.search(text)
    signs = "&" in text and _ENTITY.search(text)
    return bool(unusual or signs or _MAYBE_AT.search(text) or _MAY_BE_BARE.search(text) or _MAYBE_SPELLED.search(text))


def disguised(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Identifiers that only the rewritten text shows, as spans of the source."""
    return uncovered(text, base) if may_be_disguised(text) else []


def uncovered(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The same without a look ahead."""
    source = Tape.of(text)
    tape = at_and_dot(spelled_digits(characters(entities(source))))
    if tape is source:
        return []
    out = []
    for s, e, kind in identifiers(tape.text):
        a, b = tape.start[s], tape.end[e - 1]
        if text[a:b] != tape.text[s:e] and not any(k == kind and x <= a and b <= y for x, y, k in base):
            out.append((a, b, kind))
    return out


def find_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Plain spans and added ones."""
    base = identifiers(text)
    return base, disguised(text, base)


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def redact(text: str) -> str:
    """The text with each identifier replaced by its kind; overlapping spans become one."""
    base, added = find_spans(text)
    out, at = [], 0
    merged: list[list] = []
    for s, e, kind in sorted(base + added, key=lambda x: (x[0], -x[1])):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e, kind])
    for s, e, kind in merged:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in each text, in code points.

    The counts and ``base_sha256`` are of plain identifiers, ``spans`` lists these and the
    ``n_added`` disguised ones.  A null or empty text has none (the hash of an empty string).
    Every row gives a row, also with a null or repeated id; other columns are not read.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in part.column(1).to_pylist():
            base, added = find_spans(text)
            count = [sum(x[2] == k for x in base) for k in KINDS]
            rows.append((*count, hashlib.sha256(digest(base).encode()).hexdigest(), digest(base + added), len(added)))
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([part.column(0), *columns], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return map_texts(id_and_text(docs, id_col, text_col), run, SCHEMA)


def redact_pii(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, with identifiers in ``text`` replaced by their kind.

    ``n_chars``, if there, follows the new text.  Null texts stay null.
    """
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                texts = [t if t is None else redact(t) for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    bounded_batches(docs.sparkSession)
    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out
