"""A character convolutional network in numpy, with training, calibration and thresholds."""

from __future__ import annotations

import copy
from dataclasses import dataclass

import numpy as np

from gridloom.llm.logistic import Logistic, fit

#: Codes of characters: printable ASCII, line breaks, other spaces, letters beyond ASCII, others.
ASCII, OTHER = 96, 4
INSIDE = ASCII + OTHER
CODES = 2 * INSIDE
#: The convolution sees so many characters on either side.
REACH = 2
#: Positions that one step of the forward pass holds.
BLOCK = 65_536


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where((points >= 32) & (points < 127), points - 31, ASCII + 3).astype(np.int64)
    codes[(points == 10) | (points == 13)] = ASCII
    codes[(points == 9) | (points == 160)] = ASCII + 1
    codes[points >= 0xC0] = ASCII + 2
    return codes


@dataclass
class Example:
    """A candidate with the text around it."""

    before: str
    value: str
    after: str


class Flat:
    """Examples end to end; two segments each, around and inside the candidate.

    The gaps between them are a last segment of their own that nothing reads.
    """

    def __init__(self, examples: list[Example]):
        parts, segment = [], []
        gap, aside = np.zeros(REACH, np.int64), np.full(REACH, 2 * len(examples))
        for k, e in enumerate(examples):
            before, value, after = char_codes(e.before), char_codes(e.value), char_codes(e.after)
            parts += [before, value + INSIDE, after, gap]
            segment += [np.full(len(before), 2 * k), np.full(len(value), 2 * k + 1), np.full(len(after), 2 * k), aside]
        none = np.zeros(0, np.int64)
        self.codes, self.segment = (np.concatenate(x) if x else none for x in (parts, segment))
        self.n = len(examples)
        self.sizes = np.bincount(self.segment, minlength=2 * self.n + 1)[:-1]


@dataclass
class Network:
    """Embedding, one convolution, pooling (largest around; largest and mean inside), two layers."""

    embed: np.ndarray
    filters: np.ndarray  # (2 * REACH + 1, embedding, filters)
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def start(cls, seed: int, width: int = 12, filters: int = 24, hidden: int = 16) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, fan: int) -> np.ndarray:
            return (rng.standard_normal(shape) * np.sqrt(2 / fan)).astype(np.float32)

        taps, pooled = 2 * REACH + 1, 3 * filters + 1
        zeros = [np.zeros(n, np.float32) for n in (filters, hidden, 1)]
        embed = normal(CODES, width, fan=8)
        embed[0] = 0  # a gap says nothing
        return cls(embed, normal(taps, width, filters, fan=taps * width), zeros[0], normal(pooled, hidden, fan=pooled), zeros[1], normal(hidden, 1, fan=hidden), zeros[2])

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def convolved(self, codes: np.ndarray, a: int, b: int) -> np.ndarray:
        """Filters at the positions from ``a`` to ``b``, negative ones as 0."""
        low, high = max(a - REACH, 0), min(b + REACH, len(codes))
        x = self.embed[codes[low:high]]
        x = np.pad(x, ((low - (a - REACH), b + REACH - high), (0, 0)))
        h = self.bias + sum(x[k : k + b - a] @ w for k, w in enumerate(self.filters))
        return np.maximum(h, 0)

    def pooled(self, flat: Flat, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """Largest value and sum of each filter in each segment, block by block."""
        largest = np.zeros((2 * flat.n + 1, len(self.bias)), self.bias.dtype)
        total = np.zeros_like(largest)
        for a in range(0, len(flat.codes), block):
            b = min(a + block, len(flat.codes))
            h, segment = self.convolved(flat.codes, a, b), flat.segment[a:b]
            first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            np.maximum.at(largest, segment[first], np.maximum.reduceat(h, first, axis=0))
            np.add.at(total, segment[first], np.add.reduceat(h, first, axis=0))
        return largest[:-1], total[:-1]

    def features(self, flat: Flat, largest: np.ndarray, total: np.ndarray) -> np.ndarray:
        inside = np.maximum(flat.sizes[1::2], 1)[:, None].astype(self.bias.dtype)
        return np.concatenate([largest[::2], largest[1::2], total[1::2] / inside, np.log(inside) / 4], axis=1)

    def logits(self, flat: Flat, block: int = BLOCK) -> np.ndarray:
        if not flat.n:
            return np.zeros(0)
        x = self.features(flat, *self.pooled(flat, block))
        return (np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias)[:, 0].astype(float)

    def gradients(self, flat: Flat, y: np.ndarray, weight: np.ndarray | float = 1.0) -> tuple[float, list[np.ndarray]]:
        """Mean weighted logistic loss of a batch and its gradient in each parameter."""
        n, filters = flat.n, len(self.bias)
        h = self.convolved(flat.codes, 0, len(flat.codes))
        first = np.flatnonzero(np.r_[True, flat.segment[1:] != flat.segment[:-1]])
        largest, total = np.zeros((2 * n + 1, filters), self.bias.dtype), np.zeros((2 * n + 1, filters), self.bias.dtype)
        np.maximum.at(largest, flat.segment[first], np.maximum.reduceat(h, first, axis=0))
        np.add.at(total, flat.segment[first], np.add.reduceat(h, first, axis=0))
        x = self.features(flat, largest[:-1], total[:-1])
        a = x @ self.hidden + self.hidden_bias
        r = np.maximum(a, 0)
        z = (r @ self.out + self.out_bias)[:, 0].astype(float)
        loss = float((weight * (np.logaddexp(0, z) - y * z)).mean())
        dz = (weight * (0.5 * (1 + np.tanh(z / 2)) - y) / n).astype(self.bias.dtype)[:, None]
        dr = (dz @ self.out.T) * (a > 0)
        dx = dr @ self.hidden.T
        # equal largest values share their gradient
        top = (h == largest[flat.segment]) & (h > 0)
        ties = np.zeros((2 * n + 1, filters), self.bias.dtype)
        np.add.at(ties, flat.segment[first], np.add.reduceat(top, first, axis=0, dtype=self.bias.dtype))
        to_max, to_sum = np.zeros((2 * n + 1, filters), self.bias.dtype), np.zeros((2 * n + 1, filters), self.bias.dtype)
        to_max[:-1:2], to_max[1::2] = dx[:, :filters], dx[:, filters : 2 * filters]
        to_sum[1::2] = dx[:, 2 * filters : 3 * filters] / np.maximum(flat.sizes[1::2], 1)[:, None]
        dh = np.where(top, (to_max / np.maximum(ties, 1))[flat.segment], 0) + np.where(h > 0, to_sum[flat.segment], 0)
        e = np.pad(self.embed[flat.codes], ((REACH, REACH), (0, 0)))
        size = len(flat.codes)
        d_filters = np.stack([e[k : k + size].T @ dh for k in range(len(self.filters))])
        de = np.zeros_like(e)
        for k, w in enumerate(self.filters):
            de[k : k + size] += dh @ w.T
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, flat.codes, de[REACH : REACH + size])
        d_embed[0] = 0
        return loss, [d_embed, d_filters, dh.sum(axis=0), x.T @ dr, dr.sum(axis=0), r.T @ dz, dz.sum(axis=0)]


@dataclass
class Learner:
    """A network with Adam's running moments, so that learning can go on elsewhere."""

    network: Network
    moments: list[tuple[np.ndarray, np.ndarray]]
    steps: int = 0

    @classmethod
    def start(cls, seed: int) -> Learner:
        net = Network.start(seed)
        return cls(net, [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()])

    def arrays(self) -> list[np.ndarray]:
        return [*self.network.parameters(), *(x for two in self.moments for x in two)]

    def learn(self, examples: list[Example], y: np.ndarray, weight: np.ndarray, rate: float, batch: int = 128) -> None:
        """Adam over batches of the examples in their order."""
        for a in range(0, len(examples), batch):
            own = slice(a, a + batch)
            _, grads = self.network.gradients(Flat(examples[own]), y[own], weight[own])
            self.steps += 1
            for p, g, (m, v) in zip(self.network.parameters(), grads, self.moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-7)


#: Step size of the first epoch; later ones take smaller steps.
RATE = 0.004


def rate_of(epoch: int, epochs: int) -> float:
    return RATE * (1 - epoch / epochs)


def averaged(learners: list[Learner], rows: list[int]) -> Learner:
    """The mean of learners that went on from one, each weighted by the rows it has seen."""
    share = np.array(rows) / sum(rows)
    out = copy.deepcopy(learners[0])
    for k, x in enumerate(out.arrays()):
        x[...] = sum(w * own.arrays()[k].astype(float) for w, own in zip(share, learners, strict=True))
    out.steps = max(own.steps for own in learners)
    return out


def train(examples: list[Example], y: np.ndarray, seed: int, epochs: int) -> Network:
    """Epochs over shuffled examples in one place."""
    learner, rng = Learner.start(seed), np.random.default_rng(seed + 1)
    for epoch in range(epochs):
        order = rng.permutation(len(examples))
        learner.learn([examples[k] for k in order], y[order], np.ones(len(y)), rate_of(epoch, epochs))
    return learner.network


def recall_threshold(score: np.ndarray, recall: float, weight: np.ndarray | None = None) -> float:
    """The largest threshold that at least a share ``recall`` of these findings reaches, by weight."""
    if not len(score):
        return float("inf")
    order = np.argsort(-score, kind="stable")
    reached = np.cumsum(np.ones(len(score)) if weight is None else weight[order])
    return float(score[order][np.searchsorted(reached, recall * reached[-1] * (1 - 1e-12))])


@dataclass
class Detector:
    """The network, the curve that turns its output into a probability, a threshold per kind."""

    network: Network
    curve: Logistic
    thresholds: dict[str, float]

    def scores(self, examples: list[Example]) -> np.ndarray:
        return self.curve.score(self.network.logits(Flat(examples))[:, None])


def calibrated(network: Network, examples: list[Example], y: np.ndarray, kinds: list[str], recall: float, least: float) -> Detector:
    """``examples`` are findings the network has not learned from."""
    return with_thresholds(network, network.logits(Flat(examples)), y, kinds, np.ones(len(examples)), recall, least)


def with_thresholds(
    network: Network, logits: np.ndarray, y: np.ndarray, kinds: list[str], weight: np.ndarray, recall: float, least: float
) -> Detector:
    """The curve and the thresholds from weighted findings, or cells of them, given by the network's output."""
    detector = Detector(network, fit(logits[:, None], y, weight=weight), {})
    score, kind = detector.curve.score(logits[:, None]), np.array(kinds)
    for k in sorted(set(kinds)):
        own = (kind == k) & (y == 1)
        detector.thresholds[k] = max(least, recall_threshold(score[own], recall, weight[own]))
    return detector
