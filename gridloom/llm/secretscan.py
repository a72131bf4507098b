"""Secrets in texts: plain rules, and a character network over every other candidate."""

from __future__ import annotations

import copy
import hashlib
import pickle
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage
from gridloom.llm.batches import bounded_batches, chunks, id_and_text, map_texts
from gridloom.llm.secretnet import Detector, Example, Flat, Learner, Network, averaged, rate_of, with_thresholds

KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# A match takes its whole run, so one of enough characters begins where the run begins.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_VALUE = "[A-Za-z0-9+/_.=-]"
#: Runs of 8 characters or more that hold a digit, and such runs behind a sign of assignment.
_CANDIDATE = re.compile(rf"(?<!{_VALUE})(?=[A-Za-z+/_.=-]*[0-9]){_VALUE}{{8,}}")
_ASSIGNED = re.compile(rf"""[:=][\x20"']{{0,3}}({_VALUE}{{8,}})""")
LEAST = 8
#: Characters of context before and behind a candidate.
BEFORE, AFTER = 28, 8


@dataclass(frozen=True)
class SecretSettings:
    #: findings of either label that ``corpus_findings`` shows; learning reads all of them
    finding_rows: int = 4000
    #: what all findings of a label in the texts weigh together at most, a made finding weighing 1
    finding_weight: float = 4000
    #: findings that one learner of an epoch sees, while there are few learners, and those of a block
    learner_rows: int = 16_384
    #: labelled findings made from known formats of secrets and of harmless values, of either label
    made_rows: int = 2500
    #: share of secrets of each kind that the thresholds must let through on findings set aside
    recall: float = 0.95
    #: no threshold goes below this probability
    least_score: float = 0.9
    #: epochs over the made findings alone that come first, so that learners' networks can be averaged
    first_epochs: int = 2
    epochs: int = 4
    seed: int = 11
    #: characters of candidates and context scored at once
    step_chars: int = 400_000


Span = tuple[int, int, str]


def plain_findings(text: str) -> list[Span]:
    """What the rules find, leftmost and without overlap in each kind, as (start, end, kind)."""
    out = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Every other value that may be a secret, without overlap, apart from plain findings."""
    found = {m.span() for m in _CANDIDATE.finditer(text)} | {m.span(1) for m in _ASSIGNED.finditer(text)}
    out, free, k = [], 0, 0
    covered = sorted((s, e) for s, e, _ in base)
    for s, e in sorted(found):
        while e > s and text[e - 1] in ".-":
            e -= 1
        while s < e and text[s] in ".-=":
            s += 1
        while k < len(covered) and covered[k][1] <= s:
            k += 1
        if e - s >= LEAST and s >= free and not (k < len(covered) and covered[k][0] < e):
            out.append((s, e))
            free = e
    return out


def around(text: str, start: int, end: int) -> Example:
    return Example(text[max(0, start - BEFORE) : start], text[start:end], text[end : end + AFTER])


def form(value: str) -> str:
    """The listed kind whose form a value has."""
    if re.fullmatch("[0-9a-fA-F-]{32,}", value):
        return "hex"
    return "access" if re.fullmatch("[A-Z0-9]{16,}", value) else "assign"


def digest(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


# ----------------------------------------------------------------------------- labelled findings

_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALNUM = _LOWER + _LOWER.upper() + _DIGITS
# Public formats of keys, as prefix, alphabet and number of characters.
KEY_FORMATS = (
    ("ghp_", _ALNUM, 36), ("gho_", _ALNUM, 36), ("npm_", _ALNUM, 36), ("AIza", _ALNUM + "_-", 35), ("sk_live_", _ALNUM, 24),
    ("xoxb-", _DIGITS + "-", 24), ("AKIA", _LOWER.upper() + _DIGITS, 16), ("", "0123456789abcdef", 32),
    ("", "0123456789abcdef", 40), ("", "0123456789abcdef", 64), ("", _ALNUM + "+/", 40), ("", _ALNUM + "+/", 64),
    ("eyJ", _ALNUM + "_-", 60), ("", _ALNUM, 20), ("", _ALNUM + "_-", 28), ("", _LOWER + _DIGITS, 16),
)
KEY_NAMES = (
    "password", "passwd", "pwd", "pass", "passphrase", "secret", "token", "auth", "credential", "private_key", "client_secret",
    "access_key", "api_key", "apikey", "Authorization: Bearer", "bearer", "signing key", "DB_PASS",
)
PLAIN_NAMES = ("id", "version", "date", "file", "see", "order", "isbn", "page", "url", "phone", "at", "width", "ref", "doi", "class", "build")
SIGNS = ("=", " = ", ": ", ":", ' = "', '="', ": '", " ")


def _pick(rng: random.Random, alphabet: str, n: int) -> str:
    return "".join(rng.choices(alphabet, k=n))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfghlmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))


def _secret(rng: random.Random) -> str:
    if rng.random() < 0.15:
        return rng.choice([str.title, str.lower])(_word(rng)) + rng.choice("_-.=") + _pick(rng, _ALNUM, rng.randint(8, 14))
    prefix, alphabet, n = rng.choice(KEY_FORMATS)
    return prefix + _pick(rng, alphabet, n)


def _harmless(rng: random.Random) -> str:
    digits = lambda n: _pick(rng, _DIGITS, n)
    words = lambda sign: sign.join(_word(rng) for _ in range(rng.randint(2, 4)))
    return rng.choice(
        [
            lambda: digits(rng.randint(8, 19)),
            lambda: f"20{digits(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}",
            lambda: f"20{digits(2)}0{rng.randint(1, 9)}{rng.randint(10, 28)}T{digits(6)}",
            lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
            lambda: f"{rng.randint(0, 20)}.{rng.randint(0, 99)}.{digits(rng.randint(1, 4))}-{rng.choice(['rc1', 'beta2', 'alpha', 'final1'])}",
            lambda: f"{words('-')}-{digits(rng.randint(1, 3))}",
            lambda: f"{words('_')}_{digits(rng.randint(1, 3))}",
            lambda: f"{_word(rng)}{words('').title()}{digits(2)}",
            lambda: f"{_word(rng)}.{_word(rng)}/{digits(4)}/{words('-')}.html",
            lambda: f"/{_word(rng)}/{_word(rng)}{digits(1)}/{words('/')}",
            lambda: f"img_{digits(8)}.jpg",
            lambda: f"mail{digits(1)}.{_word(rng)}le.com",
            lambda: f"{digits(3)}-{digits(4)}-{digits(4)}",
            lambda: f"10.{digits(4)}/{_word(rng)}.{digits(4)}",
            lambda: f"{digits(1)}.{digits(3)}.{digits(3)}.{digits(2)}",
            lambda: f"{_word(rng)}{digits(2)}.{_word(rng)}.{_word(rng)}",
            lambda: words(""),
        ]
    )().ljust(LEAST, "0")


def made_findings(n: int, seed: int) -> list[tuple[Example, int]]:
    """``n`` secrets and ``n`` harmless values of known formats, in made contexts."""
    rng = random.Random(seed)
    out = []
    for k in range(2 * n):
        label = k % 2
        prose = " ".join(_word(rng) for _ in range(8))
        # a tenth of the names stand before the other kind of value, so neither side decides alone
        names = KEY_NAMES if (rng.random() < 0.9) == bool(label) else PLAIN_NAMES
        name = "" if rng.random() < 0.35 else rng.choice(names) + rng.choice(SIGNS)
        name = rng.choice([str, str, str.upper])(name)
        quote = name[-1:] if name[-1:] in ("'", '"') else ""
        before = f"{prose}{rng.choice([' ', '. ', chr(10)])}{name}"[-rng.randint(20, 60) :][-BEFORE:]
        after = (quote + rng.choice([" ", ". ", ",", "\n"]) + _word(rng))[:AFTER]
        out.append((Example(before, _secret(rng) if label else _harmless(rng), after), label))
    return out


FINDING = "key long, place long, label int, kind string, before string, value string, after string"


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def labelled_findings(texts: DataFrame) -> DataFrame:
    """Every finding and other candidate of the texts as ``FINDING``, labelled by the plain rules.

    ``key`` is a hash of the finding with its context, ``place`` one of the key and where it
    stands, so that copies of one finding part company.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(*(c.to_pylist() for c in part.columns[:2]), strict=True):
            base = plain_findings(text)
            spans = [(s, e, 1) for s, e, _ in base] + [(s, e, 0) for s, e in candidates(text, base)]
            for s, e, label in spans:
                x = around(text, s, e)
                if label and (m := _ASSIGN.fullmatch(text, s, e)):
                    x = around(text, *m.span(2))
                key = _hash(f"{x.before}\0{x.value}\0{x.after}")
                rows.append((key, _hash(f"{doc_id} {s} {key}"), label, form(x.value), x.before, x.value, x.after))
        types = [pa.int64()] * 2 + [pa.int32()] + [pa.string()] * 4
        columns = list(zip(*rows, strict=True)) or [()] * 7
        names = [x.split()[0] for x in FINDING.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return cut_lineage(map_texts(texts, run, FINDING))


def corpus_findings(texts: DataFrame, settings: SecretSettings) -> list[tuple[Example, int]]:
    """Up to ``finding_rows`` labelled findings of either label, to look at; :func:`learn` reads all of them."""
    found = labelled_findings(texts)
    out = []
    for label in (1, 0):
        rows = found.where(F.col("label") == label).orderBy("key", "before", "value", "after").limit(settings.finding_rows).collect()
        out += [(Example(r.before, r.value, r.after), label) for r in rows]
    return out


#: Characters of a value that one step of learning sees; calibration and scoring read values whole.
VALUE_CHARS = 512
#: Cells of the network's output, per unit, in which findings are counted for calibration.
GRID, MOST_LOGIT = 1024, 50
#: Learners of an epoch at most; with more findings each one sees more of them.
LEARNERS = 256


def learn(texts: DataFrame, settings: SecretSettings) -> Detector:
    """The network learns from four fifths of all findings, and of the made ones; the others calibrate it.

    Equal findings are all on the same side.
    """
    found = labelled_findings(texts).withColumn("held", F.pmod("key", F.lit(5)) == 0)
    count = {(r.held, r.label): r["count"] for r in found.groupBy("held", "label").count().collect()}
    total = [count.get((False, k), 0) + count.get((True, k), 0) for k in (0, 1)]
    weight = [min(1.0, settings.finding_weight / max(n, 1)) for n in total]
    rng = random.Random(settings.seed)
    learned, kept = [], []
    for x in made_findings(settings.made_rows, settings.seed):
        (kept if rng.random() < 0.2 else learned).append(x)
    rows = count.get((False, 0), 0) + count.get((False, 1), 0)
    network = trained(found.where("not held"), rows, weight, learned, settings)

    logits = network.logits(Flat([x for x, _ in kept]))
    cells = [(y, form(x.value), z, 1.0) for (x, y), z in zip(kept, logits.tolist(), strict=True)]
    counted = counted_outputs(found.where("held"), network, settings).orderBy("label", "kind", "cell").collect()
    cells += [(r.label, r.kind, r.cell / GRID, r.n * weight[r.label]) for r in counted]
    y, kinds, logits, w = zip(*cells, strict=True) if cells else ((),) * 4
    return with_thresholds(network, np.array(logits), np.array(y, float), list(kinds), np.array(w), settings.recall, settings.least_score)


def trained(found: DataFrame, rows: int, weight: list[float], made: list[tuple[Example, int]], settings: SecretSettings) -> Network:
    """Each epoch deals the findings to learners that go on from the same network, and averages these.

    The first network comes from the made findings.  A learner sees its share of the findings in blocks, with all made ones spread over them.
    Findings weigh so that those of a label count as ``finding_weight`` together to a learner,
    or as their number if there are fewer, beside the made ones.
    """
    spark = found.sparkSession
    learners = min(LEARNERS, max(1, -(-rows // settings.learner_rows)))
    weight = [min(1.0, w * learners) for w in weight]
    expected = rows / learners
    learner = Learner.start(settings.seed)
    for epoch in range(settings.first_epochs):
        random.Random(f"{settings.seed} {epoch}").shuffle(made)
        learner.learn([x for x, _ in made], np.array([y for _, y in made], float), np.ones(len(made)), rate_of(0, settings.epochs))
    shared_made = spark.sparkContext.broadcast(made)
    value = F.substring("value", 1, VALUE_CHARS).alias("value")
    found = found.select("key", "place", "label", "before", value, "after")
    bounded_batches(spark)
    for epoch in range(settings.epochs):
        start = spark.sparkContext.broadcast(learner)
        rate = rate_of(epoch, settings.epochs)

        def go_on(blocks: Iterator[list[tuple[Example, int]]], own: Learner, made, epoch=epoch, rate=rate) -> int:
            rng = np.random.default_rng([settings.seed, epoch])
            seen = taken = 0
            for block in blocks:
                seen += len(block)
                upto = round(len(made) * seen / expected) if expected else len(made)
                more = [made[k % len(made)] for k in range(taken, upto)]
                taken = upto
                examples = [(x, y, weight[y]) for x, y in block] + [(x, y, 1.0) for x, y in more]
                # the value alone has to do at times
                alone = rng.random(len(examples)) < 0.3
                examples += [(Example("", x.value, ""), y, w) for (x, y, w), a in zip(examples, alone, strict=True) if a]
                order = [examples[k] for k in rng.permutation(len(examples))]
                own.learn([x for x, _, _ in order], np.array([y for _, y, _ in order], float), np.array([w for *_, w in order]), rate)
            return seen

        def run(batches: Iterator[pa.RecordBatch], start=start, go_on=go_on) -> Iterator[pa.RecordBatch]:
            own = copy.deepcopy(start.value)
            seen = go_on(_blocks(batches, settings.learner_rows), own, shared_made.value)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([pickle.dumps(own)], pa.binary())], names=["seen", "state"])

        order = F.xxhash64("place", F.lit(epoch))
        dealt = found.repartition(learners, "place").sortWithinPartitions(order, "place", "key", "label")
        done = dealt.mapInArrow(run, "seen long, state binary").collect()
        if done:
            learner = averaged([pickle.loads(r.state) for r in done], [r.seen for r in done])
        else:
            go_on(iter([[]]), learner, made)
    return learner.network


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple[Example, int]]]:
    """Labelled findings in blocks of ``most`` or a few more."""
    own: list[tuple[Example, int]] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("before", "value", "after", "label"))
        own += [(Example(b, v, a), y) for b, v, a, y in zip(*columns, strict=True)]
        if len(own) >= most:
            yield own
            own = []
    if own:
        yield own


def counted_outputs(found: DataFrame, network: Network, settings: SecretSettings) -> DataFrame:
    """How many findings (``n``) of each label and kind have a network output in each cell of the grid."""
    shared = found.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "value"):
                examples = [Example(*x) for x in zip(*(part.column(c).to_pylist() for c in ("before", "value", "after")), strict=True)]
                logits = np.concatenate([shared.value.logits(Flat(own)) for own in _in_steps(examples, settings.step_chars)])
                cell = np.floor(np.clip(logits, -MOST_LOGIT, MOST_LOGIT) * GRID).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("kind"), pa.array(cell)], names=["label", "kind", "cell"])

    bounded_batches(found.sparkSession)
    cells = found.select("label", "kind", "before", "value", "after").mapInArrow(run, "label int, kind string, cell long")
    return cells.groupBy("label", "kind", "cell").agg(F.count(F.lit(1)).alias("n"))


def _in_steps(examples: list[Example], most: int) -> Iterator[list[Example]]:
    own, held = [], 0
    for x in examples:
        own.append(x)
        held += len(x.value) + BEFORE + AFTER
        if held >= most:
            yield own
            own, held = [], 0
    if own:
        yield own


def added_findings(texts: list[str], base: list[list[Span]], detector: Detector, step_chars: int) -> list[list[Span]]:
    """For each text the candidates whose score reaches the threshold of their form."""
    where = [(k, *span) for k, text in enumerate(texts) for span in candidates(text, base[k])]
    out: list[list[Span]] = [[] for _ in texts]
    examples = [around(texts[k], s, e) for k, s, e in where]
    scores = [detector.scores(own) for own in _in_steps(examples, step_chars)]
    for (k, s, e), x, score in zip(where, examples, np.concatenate(scores) if scores else [], strict=True):
        kind = form(x.value)
        if score >= detector.thresholds.get(kind, float("inf")):
            out[k].append((s, e, kind))
    return out


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"


def find_secrets(
    docs: DataFrame, settings: SecretSettings = SecretSettings(), *, id_col: str = "doc_id", text_col: str = "text", detector: Detector | None = None
) -> DataFrame:
    """Spans of secrets in each text, in code points.

    The counts and ``base_sha256`` are of what the plain rules find; ``spans`` lists these and
    the ``n_added`` candidates that the network adds.  Without a ``detector`` one is learned
    from all findings in ``docs`` and from made ones.

    A null or empty text has no findings (the hash of an empty string).  Every row gives a row,
    also with a null or repeated id; equal texts get equal spans.  A text is read whole and must
    fit in a task; candidates of any length are scored whole, in blocks.  Other columns are not
    read.
    """
    texts = id_and_text(docs, id_col, text_col)
    detector = detector or learn(texts, settings)
    shared = docs.sparkSession.sparkContext.broadcast(detector)  # some 20,000 numbers

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        own = part.column(1).to_pylist()
        base = [plain_findings(t) for t in own]
        rows = []
        for b, more in zip(base, added_findings(own, base, shared.value, settings.step_chars), strict=True):
            count = [sum(x[2] == k for x in b) for k in KINDS]
            rows.append((*count, hashlib.sha256(digest(b).encode()).hexdigest(), digest(b + more), len(more)))
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([part.column(0), *columns], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return map_texts(texts, run, SCHEMA)


def redact_secrets(docs: DataFrame, detector: Detector, settings: SecretSettings = SecretSettings()) -> DataFrame:
    """All rows and columns of ``docs``, with findings in ``text`` replaced by ``[SECRET]``; null texts stay null."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                own = part.column(at).to_pylist()
                base = [plain_findings(t or "") for t in own]
                more = added_findings([t or "" for t in own], base, shared.value, settings.step_chars)
                new = [t if t is None else replaced(t, b + m) for t, b, m in zip(own, base, more, strict=True)]
                yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def replaced(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if e > at:
            if s >= at:
                out += [text[at:s], "[SECRET]"]
            at = e
    return "".join(out) + text[at:]
