import hashlib
import random
import re

import pytest

from gridloom.llm.pii import KINDS, LOOKALIKES, Tape, characters, find_pii, find_spans, identifiers, redact, redact_pii, spelled_digits, uncovered

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    """Base spans by the plain expressions."""
    out = []
    for kind, expr in PLAIN.items():
        for m in re.finditer(expr, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def test_base_spans_equal_the_expressions():
    rng = random.Random(2)
    letters = ["a", "Z", "@", ".", "1", "0", "4111", " ", "-", "+", "(", ")", "255", "256", "%", "é", "\n", "b.c", "4111 1111 1111 1111"]
    for _ in range(4000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 40)))
        assert identifiers(text) == brute(text), text


def test_documents_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in find_pii(docs).collect()}
    found = 0
    for r in docs.collect():
        base = brute(r.text)
        found += len(base)
        listed = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        row = got[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in KINDS] == [sum(x[2] == k for x in base) for k in KINDS]
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
    assert found


@pytest.mark.parametrize(
    "text, source, kind",
    [
        ("mail john [at] example [dot] com now", "john [at] example [dot] com", "email"),
        ("to john dot doe at example dot org.", "john dot doe at example dot org", "email"),
        ("x jоhn@mail.com y", "jоhn@mail.com", "email"),
        ("joe(at)mail.example.com", "joe(at)mail.example.com", "email"),
        ("a​b@c.de", "a​b@c.de", "email"),
        ("call plus one two three four five six seven eight nine zero one!", "plus one two three four five six seven eight nine zero one", "phone"),
        ("ip one nine two dot one six eight dot one dot two five", "one nine two dot one six eight dot one dot two five", "ip"),
        ("ring five five five, one two three - four five six seven.", "five five five, one two three - four five six seven", "phone"),
        ("tel +1 five five five 123 four five six seven ok", "+1 five five five 123 four five six seven", "phone"),
        ("write to jo.doe @ mail.example . com soon", "jo.doe @ mail.example . com", "email"),
        ("jo&#64;mail&#46;example.com", "jo&#64;mail&#46;example.com", "email"),
        ("４１１１ １１１１ １１１１ １１１１", "４１１１ １１１１ １１１１ １１１１", "card"),
    ],
)
def test_disguises_map_back(text, source, kind):
    _, added = find_spans(text)
    assert [(text[s:e], k) for s, e, k in added] == [(source, kind)]
    assert f"[{kind.upper()}]" in redact(text) and source not in redact(text)


@pytest.mark.parametrize(
    "text", ["look at the dot product", "one two three", "we met at noon", "at", "é ß “q” – …", "um zero one", "x [.] y", "follow @example.com", "we meet @ noon . Come", "un " * 12, "one two 3 4 5 6 7 8 9 10 11", "a & b &amp; c"]
)
def test_ordinary_text_is_left_alone(text):
    assert find_spans(text) == ([], []) and redact(text) == text


@pytest.mark.parametrize("text, source", [("mail jane@example dot com now", "jane@example dot com"), ("john dot doe@example dot org", "john dot doe@example dot org")])
def test_a_sign_with_spelled_dots(text, source):
    _, added = find_spans(text)
    assert [(text[s:e], k) for s, e, k in added] == [(source, "email")]


@pytest.mark.parametrize(
    "text, source, kind",
    [
        ("write anna at firma dot pl now", "anna at firma dot pl", "email"),
        ("to joe at site dot ca, please", "joe at site dot ca", "email"),
        ("ana arroba correo punto mx", "ana arroba correo punto mx", "email"),
        ("call +1 555 123 four five six 7890 now", "+1 555 123 four five six 7890", "phone"),
        ("ring five one five one five one five one five one now", "five one five one five one five one five one", "phone"),
        ("ring (five five five) one two three four five six seven.", "five five five) one two three four five six seven", "phone"),
        ("plus (one two) three four five six seven eight nine zero!", "plus (one two) three four five six seven eight nine zero", "phone"),
        ("pay 4111 1111 1111 one one one one today", "4111 1111 1111 one one one one", "card"),
        ("at 192 dot 168 dot one dot 25", "192 dot 168 dot one dot 25", "ip"),
        ("mail jane@example·com now", "jane@example·com", "email"),
    ],
)
def test_disguises_beyond_the_lists(text, source, kind):
    _, added = find_spans(text)
    assert [(text[s:e], k) for s, e, k in added] == [(source, kind)]


@pytest.mark.parametrize("text", ["we stopped at some point in May", "look at this dot here", "meet at that point we said", "l·l and cel·la", "un deux trois (quatre) cinq", "page 1, two, 3 (four) of 12"])
def test_ordinary_text_beside_them(text):
    assert find_spans(text) == ([], [])


def test_an_article_is_no_digit_of_a_plain_number():
    assert find_spans("Por évi. +1 (848) 555-1373 Un an oule") == ([(9, 26, "phone")], [])


def test_every_look_alike_is_read():
    assert all(characters(Tape.of(c)).text == new for c, new in LOOKALIKES.items())


def test_the_look_ahead_loses_nothing():
    rng = random.Random(8)
    parts = ["jane", "example", "com", "org", "@", " @ ", " at ", " arroba ", " dot ", " punto ", " point ", ".", " . ", "[at]", "(dot)", "&#64;", "·", " ", "one", "five", "3", "4111", "plus ", "+", "-", ") "]
    some = 0
    for _ in range(20000):
        text = "".join(rng.choices(parts, k=rng.randint(3, 14)))
        base, added = find_spans(text)
        some += len(added)
        assert added == uncovered(text, base), text
    assert some


def test_tape_keeps_source_spans():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choices(["а", "１", "​", "b", " ", "one ", "two-", "é"], k=30))
        tape = spelled_digits(characters(Tape.of(text)))
        assert len(tape.text) == len(tape.start) == len(tape.end)
        assert all(s < e for s, e in zip(tape.start, tape.end, strict=True))
        assert list(tape.start) == sorted(tape.start) and list(tape.end) == sorted(tape.end)


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "@a" * 200_000, "one " * 100_000, "a at " * 50_000, "a @ " * 50_000, "&#" * 100_000, "one 1 " * 50_000, "+1(" * 100_000):
        assert len(find_spans(text)) == 2


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, "a@b.co", 6, 1), (1, None, None, 2), (1, "", 0, 3), (1, "x a@b.co", 8, 4), (1, "x a@b.co", 8, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans int")
    got = sorted((repr(r.doc_id), r.n_email, r.spans) for r in find_pii(df).collect())
    assert got == [("1", 0, ""), ("1", 0, ""), ("1", 1, "email:2:8"), ("1", 1, "email:2:8"), ("None", 1, "email:0:6")]
    out = redact_pii(df)
    assert out.columns == df.columns
    want = [(None, "[EMAIL]", 7, 1), (1, None, None, 2), (1, "", 0, 3), (1, "x [EMAIL]", 9, 4), (1, "x [EMAIL]", 9, 4)]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))
    assert find_pii(df.limit(0)).collect() == [] and redact_pii(df.limit(0)).collect() == []
