"""A bidirectional window network in numpy: the words on either side of a place, never the word itself, predict the word.

Every code has a vector. A place's hidden layer is the tanh of a sum over its neighbours' vectors, each scaled
by a vector of its distance. A code is predicted as a class and then a member of that class, each by a softmax.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Classes, members of a class, words on either side, hidden units.
CLASSES, MEMBERS, REACH, HIDDEN = 48, 64, 3, 24
CODES = CLASSES * MEMBERS
#: The code of a place outside a document; it has a vector and is never predicted.
OUTSIDE = CODES
OFFSETS = (*range(-REACH, 0), *range(1, REACH + 1))


@dataclass
class Network:
    """Weights, in the order of parts()."""

    vectors: np.ndarray
    scale: np.ndarray
    bias: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_member: np.ndarray
    member_bias: np.ndarray

    SHAPES = ((CODES + 1, HIDDEN), (len(OFFSETS), HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (CLASSES, HIDDEN, MEMBERS), (CLASSES, MEMBERS))
    SIZE = sum(int(np.prod(s)) for s in SHAPES)

    @staticmethod
    def begin(counts: np.ndarray | None = None, seed: int = 5) -> Network:
        """Small random weights; biases that give each code its share of `counts`, so that training only adds contexts."""
        rng = np.random.default_rng(seed)
        draw = lambda shape, width: rng.normal(0, width, shape).astype(np.float32)
        n = (np.zeros(CODES) if counts is None else counts).reshape(CLASSES, MEMBERS) + 0.5
        s = Network.SHAPES
        return Network(
            draw(s[0], 0.3), 1 + draw(s[1], 0.2), np.zeros(s[2], np.float32), draw(s[3], 0.05), np.log(n.sum(axis=1) / n.sum()).astype(np.float32),
            draw(s[5], 0.05), np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.scale, self.bias, self.to_class, self.class_bias, self.to_member, self.member_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @staticmethod
    def of(flat: np.ndarray) -> Network:
        out, at = [], 0
        for shape in Network.SHAPES:
            n = int(np.prod(shape))
            out.append(np.array(flat[at : at + n], dtype=np.float32).reshape(shape))
            at += n
        return Network(*out)

    def hidden(self, near: np.ndarray) -> np.ndarray:
        """The hidden layer at places REACH to len(near) - REACH of the neighbours' vectors `near`."""
        z = np.tile(self.bias, (len(near) - 2 * REACH, 1))
        wide, part = np.tile(self.scale, (1, WIDE)), np.empty((4 * BLOCK, HIDDEN), np.float32)
        for lo, hi in _blocks(0, len(z), len(part)):
            for o, d in zip(OFFSETS, wide):
                z[lo:hi] += _scaled(near[REACH + o + lo : REACH + o + hi], d, part)
            np.tanh(z[lo:hi], out=z[lo:hi])
        return z

    def _near(self, stream: np.ndarray) -> np.ndarray:
        """The vectors of a stream's codes."""
        return np.take(self.vectors, stream.astype(np.int64), axis=0)

    def _layers(self, t: _Targets) -> list[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
        """For members and for classes: weights, the biases as their last row; what is to be predicted; and (weights, from,
        to) of the runs of targets that have the same ones."""
        to_member = np.concatenate((self.to_member, self.member_bias[:, None]), axis=1)
        to_class = np.concatenate((self.to_class, self.class_bias[None]))[None]
        return [(to_member, t.member, t.runs), (to_class, t.cls, [(0, 0, len(t.cls))])]

    def log_probs(self, stream: np.ndarray) -> np.ndarray:
        """The log-probability of each code of a stream but the first and last REACH; 0 where it is OUTSIDE."""
        t = _Targets.of(stream[REACH : len(stream) - REACH])
        h = t.sorted(self.hidden(self._near(stream)))
        lp = sum(_log_softmax_at(_logits(h, weights, runs), at) for weights, at, runs in self._layers(t))
        out = np.zeros(len(t.order), np.float32)
        out[t.order[: len(h)]] = lp
        return out

    def gradients(self, stream: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]] | None:
        """(codes whose vectors have a gradient, gradients by parts()) of the mean negative log-probability.

        The first gradient has a row for each of those codes. None if nothing in the stream is predicted.
        """
        t = _Targets.of(stream[REACH : len(stream) - REACH])
        n = len(t.cls)
        if not n:
            return None
        near = self._near(stream)
        h = t.sorted(self.hidden(near))
        gh, part = np.zeros((len(t.order), HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32)
        found = []
        for weights, at, runs in self._layers(t):
            x, grad = _logits(h, weights, runs), np.zeros_like(weights)
            share = _errors(x, at)[:, None]
            scaled = h * share
            for c, lo, hi in runs:
                np.matmul(scaled[lo:hi].T, x[lo:hi], out=grad[c])
                np.matmul(x[lo:hi], weights[c, :HIDDEN].T, out=part[lo:hi])
            part *= share
            gh[:n] += part
            found.append(grad)
        h = h[:, :HIDDEN]
        gh[:n] *= 1 - h * h
        gz = t.placed(gh)
        g_near, g_scale = np.zeros_like(near), np.empty_like(self.scale)
        wide, part, ones = np.tile(self.scale, (1, WIDE)), np.empty_like(gz), np.ones(len(gz), np.float32)
        for i, o in enumerate(OFFSETS):
            at = slice(REACH + o, REACH + o + len(gz))
            g_near[at] += _scaled(gz, wide[i], part)
            g_scale[i] = ones @ np.multiply(gz, near[at], out=part)
        at = stream.astype(np.int64)
        codes = np.flatnonzero(np.bincount(at, minlength=CODES + 1))
        g_vectors = np.stack([np.bincount(at, g, CODES + 1)[codes] for g in np.ascontiguousarray(g_near.T)], axis=1).astype(np.float32)
        g_member, g_class = found
        return codes, [g_vectors, g_scale, ones @ gz, g_class[0, :HIDDEN], g_class[0, HIDDEN], g_member[:, :HIDDEN], g_member[:, HIDDEN]]


@dataclass
class _Targets:
    """What a stream's places predict: places by class, those outside last; class and member of each that is predicted,
    and (class, from, to) of the run of each class."""

    order: np.ndarray
    cls: np.ndarray
    member: np.ndarray
    runs: list[tuple[int, int, int]]

    @staticmethod
    def of(goal: np.ndarray) -> _Targets:
        order = np.argsort((goal // MEMBERS).astype(np.uint8), kind="stable")  # OUTSIDE is beyond all classes
        cls, member = np.divmod(goal[order[: np.count_nonzero(goal != OUTSIDE)]].astype(np.int64), MEMBERS)
        ends = np.cumsum(np.bincount(cls, minlength=CLASSES)).tolist()
        return _Targets(order, cls, member, [(c, lo, hi) for c, (lo, hi) in enumerate(zip([0, *ends], ends)) if hi > lo])

    def sorted(self, rows: np.ndarray) -> np.ndarray:
        """The rows of places that are predicted in the order of classes, and a column of ones, which biases are weights of."""
        out = np.ones((len(self.cls), HIDDEN + 1), np.float32)
        out[:, :HIDDEN] = np.take(rows, self.order[: len(self.cls)], axis=0)
        return out

    def placed(self, rows: np.ndarray) -> np.ndarray:
        """Rows in the order of classes, those of places outside last, at their places."""
        at = np.empty_like(self.order)
        at[self.order] = np.arange(len(at))
        return np.take(rows, at, axis=0)


class Learner:
    """Adagrad steps on a network; only the vectors that a stream holds are touched."""

    def __init__(self, net: Network, rate: float, begin: float = 1e-5) -> None:
        self.net, self.rate = net, rate
        self.squares = [np.full_like(p, begin) for p in net.parts()]

    def step(self, stream: np.ndarray) -> bool:
        """Whether the stream had anything to predict, and so moved the weights."""
        found = self.net.gradients(stream)
        if found is None:
            return False
        codes, grads = found
        first = grads[0]
        seen = self.squares[0][codes] + first * first
        self.squares[0][codes] = seen
        self.net.vectors[codes] -= self.rate * first / np.sqrt(seen)
        for p, s, g in zip(self.net.parts()[1:], self.squares[1:], grads[1:]):
            width = g * g
            s += width
            np.sqrt(s, out=width)
            g /= width
            g *= self.rate
            p -= g
        return True


#: Logits are held below this, so that their exponentials stay finite without a search for each row's largest.
TOP = np.float32(60)
#: Places that are worked on at once where a core's cache then holds what is looked at several times; rows taken as one.
BLOCK, WIDE = 1024, 16
_ONES = np.ones(max(CLASSES, MEMBERS), np.float32)


def _blocks(lo: int, hi: int, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    return ((x, min(hi, x + size)) for x in range(lo, hi, size))


def _scaled(rows: np.ndarray, wide: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Each row times a vector, of which `wide` is WIDE copies, in the first rows of `out`; numpy is fast on long rows."""
    out, many = out[: len(rows)], len(rows) // WIDE * WIDE
    np.multiply(rows[:many].reshape(-1, WIDE * HIDDEN), wide, out=out[:many].reshape(-1, WIDE * HIDDEN))
    np.multiply(rows[many:], wide[:HIDDEN], out=out[many:])
    return out


def _held(x: np.ndarray) -> np.ndarray:
    return np.minimum(x, TOP, out=x) if x.max() > TOP else x


def _sums(x: np.ndarray) -> np.ndarray:
    """Turn logits into exponentials; the sum of each row's."""
    return np.exp(x, out=x) @ _ONES[: x.shape[1]]


def _errors(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What each row of x has to be multiplied by to be the gradient of the mean negative log-softmax at `at` by the logits x.

    The logits are overwritten. Their products with weights and hidden layers, which are smaller, can be multiplied instead.
    """
    total = np.concatenate([_sums(_held(x[lo:hi])) for lo, hi in _blocks(0, len(x))])
    x[np.arange(len(x)), at] -= total
    return 1 / (total * np.float32(len(x)))


def _logits(h: np.ndarray, weights: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """A row of logits for each row of h, from the weights of its run."""
    x = np.empty((len(h), weights.shape[2]), np.float32)
    for c, lo, hi in runs:
        np.matmul(h[lo:hi], weights[c], out=x[lo:hi])
    return x


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-softmax at `at` of the logits x, which are overwritten."""
    out = np.empty(len(x), np.float32)
    for lo, hi in _blocks(0, len(x)):
        part = _held(x[lo:hi])
        picked = part[np.arange(hi - lo), at[lo:hi]]
        out[lo:hi] = picked - np.log(_sums(part))
    return out


def joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(one stream of all documents' codes, parted and closed by places outside; where each document begins in it)."""
    gap = np.full(REACH, OUTSIDE, np.uint16)
    size = np.array([len(d) + REACH for d in docs], dtype=np.int64)
    return np.concatenate([gap, *(x for d in docs for x in (d, gap))]), REACH + np.cumsum(size) - size


def parts(stream: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A stream cut so that each place but the outer REACH is predicted in one part, with its neighbours."""
    for lo in range(0, max(0, len(stream) - 2 * REACH), size):
        yield stream[lo : lo + size + 2 * REACH]
