"""Gated recurrent language model with a class-factored softmax, in numpy.

The vocabulary is ``head`` frequent words in classes of neighbouring frequency, then tail classes
whose words share one unit each. The probability of a word is that of its class given the state,
times that of the word in its class: a softmax for a head class, and for a tail class a share that
the caller knows. The output biases begin at the logarithm of the counts. Training is truncated
backpropagation: texts run side by side in windows, the state passes from window to window, the
gradient does not.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

HIDDEN = 16
CLASS_WORDS = 64
WINDOW = 32
#: Texts side by side at first and at most, steps after which they double, and units of a text that
#: are learned as one stretch.
FEW, SIDE, RAMP, SPAN = 4, 256, 50, 1024
#: Output rows that are scored at a time; their logits stay in a core's cache.
ROWS = 4096
#: Logits of a softmax that lie within so much of each other need no maximum of each row.
SPREAD = 60.0
#: The least share that a loss is taken of.
TINY = np.finfo(np.float32).tiny


@dataclass
class Weights:
    inputs: np.ndarray  # (units, 3 hidden): what an input unit adds to update, reset and candidate
    state: np.ndarray  # (hidden, 2 hidden)
    candidate: np.ndarray  # (hidden, hidden)
    class_w: np.ndarray  # (hidden, classes)
    class_b: np.ndarray
    word_w: np.ndarray  # (head classes, hidden, words)
    word_b: np.ndarray  # (head classes, words); -inf where a class has fewer words

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]


def units(head: int, tails: int) -> tuple[np.ndarray, np.ndarray]:
    """(class, word in class) of each unit; the latter is -1 for tail units."""
    words = np.arange(head)
    classes = -(-head // CLASS_WORDS)
    return np.concatenate([words // CLASS_WORDS, classes + np.arange(tails)]), np.concatenate([words % CLASS_WORDS, np.full(tails, -1)])


def initial(head_counts: np.ndarray, tail_counts: np.ndarray, seed: int = 0, hidden: int = HIDDEN) -> Weights:
    rng = np.random.default_rng(seed)
    head, tails = len(head_counts), len(tail_counts)
    classes = -(-head // CLASS_WORDS)
    padded = np.zeros(classes * CLASS_WORDS)
    padded[:head] = head_counts
    by_class = padded.reshape(classes, CLASS_WORDS)
    with np.errstate(divide="ignore"):
        word_b = np.log(by_class)
    class_b = np.log(np.concatenate([by_class.sum(axis=1), tail_counts]) + 0.1)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return Weights(
        small(head + tails, 3 * hidden), small(hidden, 2 * hidden), small(hidden, hidden),
        small(hidden, classes + tails) * 0, class_b.astype(np.float32),
        small(classes, hidden, CLASS_WORDS) * 0, word_b.astype(np.float32),
    )


def halved(w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, state, candidate) for ``step``: what the gates read is halved, for their sigmoid is
    that of half the value, 0.5 tanh(x / 2) + 0.5."""
    n = len(w.candidate)
    inputs = w.inputs.copy()
    inputs[:, : 2 * n] *= 0.5
    return inputs, 0.5 * w.state, w.candidate


def step(
    x: np.ndarray, state: np.ndarray, candidate: np.ndarray, h: np.ndarray, gates: np.ndarray | None = None, c: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """(new state, gates, candidate) of each text after reading a unit; x has the unit's row of the
    halved inputs. The gates are update and reset side by side. The last two may be given to be filled."""
    n = h.shape[1]
    gates = np.matmul(h, state, out=gates)
    gates += x[:, : 2 * n]
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    c = np.matmul(gates[:, n:] * h, candidate, out=c)
    c += x[:, 2 * n :]
    np.tanh(c, out=c)
    new = c - h
    new *= gates[:, :n]
    new += h
    return new, gates, c


def _below(w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(biases, whether a maximum of each row is needed besides) of one softmax, or of each of many.

    A state lies within -1 and 1, so the weights bound all logits; where the greatest of a row can't
    be far below the bound, the bound is taken off the biases and keeps all exponentials in range."""
    reach = np.abs(w).sum(axis=-2)
    top = (b + reach).max(axis=-1, keepdims=True, initial=-np.inf)
    far = ~(top - (b - reach).max(axis=-1, keepdims=True, initial=-np.inf) < SPREAD)
    return np.where(far, b, b - np.where(far, 0, top)), far[..., 0]


def _exponents(states: np.ndarray, w: np.ndarray, b: np.ndarray, far: bool) -> np.ndarray:
    """Logits of each row, less a number of the row that keeps their exponentials in range; b and far
    are from ``_below``."""
    x = states @ w
    x += b
    if far:
        x -= x.max(axis=1, keepdims=True)
    return x


def _log_shares(states: np.ndarray, w: np.ndarray, b: np.ndarray, far: bool, target: np.ndarray) -> np.ndarray:
    """Natural log of the share that the softmax of each row gives its target; b and far as in ``_exponents``."""
    out = np.empty(len(target), np.float64)
    for a in range(0, len(target), ROWS):
        some = target[a : a + ROWS]
        x = _exponents(states[a : a + ROWS], w, b, far)
        at = x[np.arange(len(some)), some]
        np.exp(x, out=x)
        out[a : a + ROWS] = at - np.log(x @ np.ones(x.shape[1], x.dtype))
    return out


def _towards(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """(softmax of each row less 1 at its target, summed negative log of the targets' shares); x, from
    ``_exponents``, is overwritten."""
    p = np.exp(x, out=x)
    p *= (1 / (p @ np.ones(p.shape[1], p.dtype)))[:, None]
    rows = np.arange(len(target))
    shares = p[rows, target]
    loss = -float(np.log(np.maximum(shares, TINY)).sum())
    p[rows, target] = shares - 1
    return p, loss


def _sorted(x: np.ndarray) -> np.ndarray:
    """Stable order of small whole numbers."""
    return np.argsort(x.astype(np.int16) if len(x) and x.max() < 1 << 15 else x, kind="stable")


def log_probability(w: Weights, states: np.ndarray, cls: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Natural log of P(class) times, in head classes, P(word | class), for each state and target."""
    out = _log_shares(states, w.class_w, *_below(w.class_w, w.class_b), cls)
    word_b, far = _below(w.word_w, w.word_b)
    order = _sorted(cls)
    edges = np.searchsorted(cls[order], np.arange(len(w.word_b) + 1))
    for k in range(len(w.word_b)):
        rows = order[edges[k] : edges[k + 1]]
        if len(rows):
            out[rows] += _log_shares(states[rows], w.word_w[k], word_b[k], far[k], word[rows])
    return out


def score(w: Weights, unit: np.ndarray, first: np.ndarray, cls_of: np.ndarray, word_of: np.ndarray, window: int = 64) -> np.ndarray:
    """Log probability (natural) of each text; its units are unit[first[i]:first[i + 1]]. The state of
    a text passes through all its windows, so the whole text is one sequence."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    out = np.zeros(len(counts))
    begin, left = first[:-1][order], counts[order]
    h = np.zeros((len(order), w.candidate.shape[0]), np.float32)
    inputs, state, candidate = halved(w)
    for low in range(0, int(left[0]) if len(left) else 0, window):
        rows, units_read, states = [], [], []
        for t in range(low, min(low + window, int(left[0]))):
            n = int(np.searchsorted(-left, -t, side="left"))  # texts longer than t
            u = unit[begin[:n] + t]
            states.append(h[:n].copy())
            units_read.append(u)
            rows.append(order[:n])
            for a in range(0, n, ROWS):
                b = min(n, a + ROWS)
                h[a:b] = step(inputs[u[a:b]], state, candidate, h[a:b])[0]
        u = np.concatenate(units_read)
        lp = log_probability(w, np.concatenate(states), cls_of[u], word_of[u])
        out += np.bincount(np.concatenate(rows), lp, len(counts))
    return out


def gradients(w: Weights, h: np.ndarray, unit: np.ndarray, real: np.ndarray, cls_of: np.ndarray, word_of: np.ndarray) -> tuple[list, np.ndarray, float]:
    """(gradients of the mean loss, state after the window, summed loss) of one window: unit (texts,
    steps), real where a text still has a unit. Each unit is predicted from the state before it."""
    b, steps = unit.shape
    n = h.shape[1]
    before, gates, cs = (np.empty((steps, b, k), h.dtype) for k in (n, 2 * n, n))
    inputs, state, candidate = halved(w)
    x = inputs[unit.T]
    full = real.all(axis=0).tolist()
    for t in range(steps):
        before[t] = h
        new = step(x[t], state, candidate, h, gates[t], cs[t])[0]
        h = new if full[t] else np.where(real[:, t, None], new, h)
    flat = real.T.ravel()
    every_real = all(full)
    target = unit.T.ravel()
    states = before.reshape(steps * b, n)
    if not every_real:
        target, states = target[flat], states[flat]
    total = max(1, len(target))
    g = [np.zeros_like(x) for x in w.arrays()]
    # from here on by unit, whose order is that of the classes too
    order = _sorted(target)
    sorted_target, sorted_states = target[order], states[order]
    cls, word = cls_of[sorted_target], word_of[sorted_target]
    d, loss = _towards(_exponents(sorted_states, w.class_w, *_below(w.class_w, w.class_b)), cls)
    d *= 1 / total
    g[3] += sorted_states.T @ d
    g[4] += d.sum(axis=0)
    d_sorted = d @ w.class_w.T
    word_b, far = _below(w.word_w, w.word_b)
    far = far.tolist()
    edges = np.searchsorted(cls, np.arange(len(w.word_b) + 1)).tolist()
    for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
        if i == j:
            continue
        here = sorted_states[i:j]
        d, more = _towards(_exponents(here, w.word_w[k], word_b[k], far[k]), word[i:j])
        loss += more
        d *= 1 / total
        g[5][k] += here.T @ d
        g[6][k] += d.sum(axis=0)
        d_sorted[i:j] += d @ w.word_w[k].T
    if every_real:
        every = np.empty((b * steps, n), states.dtype)
        every[order] = d_sorted
    else:
        every = np.zeros((b * steps, n), states.dtype)
        every[np.flatnonzero(flat)[order]] = d_sorted
    every = every.reshape(steps, b, n)
    # what each step's gradient is multiplied by, of all steps at once
    z, r = gates[:, :, :n], gates[:, :, n:]
    by_c, by_gates, rest = (1 - cs * cs) * z, gates * (1 - gates), 1 - z
    by_gates[:, :, :n] *= cs - before
    by_gates[:, :, n:] *= before
    dh = np.zeros((b, n), states.dtype)
    d_x = np.empty((steps, b, 3 * n), states.dtype)
    state_t, candidate_t = np.ascontiguousarray(w.state.T), np.ascontiguousarray(w.candidate.T)
    for t in range(steps - 1, -1, -1):
        keep = real[:, t, None]
        d_new = dh if full[t] else np.where(keep, dh, 0)
        d_c = np.multiply(d_new, by_c[t], out=d_x[t, :, 2 * n :])
        d_rh = d_c @ candidate_t
        d_gates = d_x[t, :, : 2 * n]
        np.multiply(d_new, by_gates[t, :, :n], out=d_gates[:, :n])
        np.multiply(d_rh, by_gates[t, :, n:], out=d_gates[:, n:])
        back = d_gates @ state_t
        back += d_new * rest[t]
        d_rh *= r[t]
        back += d_rh
        dh = (back if full[t] else np.where(keep, back, dh)) + every[t]
    # the weights' gradients of all steps at once; units that are not real have none
    d_x, reset = d_x.reshape(steps * b, 3 * n), r.reshape(steps * b, n)
    if not every_real:
        d_x, reset = d_x[flat], reset[flat]
    g[1] += states.T @ d_x[:, : 2 * n]
    g[2] += (reset * states).T @ d_x[:, 2 * n :]
    if len(order):
        at = np.flatnonzero(np.diff(sorted_target, prepend=-1))
        g[0][sorted_target[at]] = np.add.reduceat(d_x[order], at)
    return g, h, loss


def spans(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first unit, number of units) of stretches of at most SPAN units that make up the texts."""
    counts = np.diff(first)
    n = -(-counts // SPAN)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(first[:-1], n) + SPAN * at
    return begin, np.minimum(np.repeat(first[1:], n) - begin, SPAN)


class Trainer:
    """Adam from given weights, which are copied, over texts that come piece by piece.

    Windows of texts of like length run side by side, few of them at first and twice as many after
    every RAMP steps, up to SIDE: the rule is one for every amount of text. Texts beyond SPAN units
    are learned in stretches, each of which begins without a state.
    """

    def __init__(self, w: Weights, cls_of: np.ndarray, word_of: np.ndarray, rate: float):
        self.w = Weights(*[x.copy() for x in w.arrays()])
        self.cls_of, self.word_of, self.rate = cls_of, word_of, rate
        self.moments = [[np.zeros_like(x), np.zeros_like(x)] for x in self.w.arrays()]
        self.steps, self.units, self.rng = 0, 0, np.random.default_rng(0)

    def learn(self, unit: np.ndarray, first: np.ndarray) -> None:
        """One pass over the texts unit[first[i]:first[i + 1]]."""
        begin, counts = spans(first)
        order = np.argsort(-counts, kind="stable")
        blocks = [order[i : i + SIDE] for i in range(0, len(order), SIDE)]
        for k in self.rng.permutation(len(blocks)):
            rest = blocks[k]
            while len(rest):
                side = min(SIDE, FEW << min(self.steps // RAMP, 30))
                rows, rest = rest[:side], rest[side:]
                self._texts(unit, begin[rows], counts[rows])
        self.units += int(counts.sum())

    def _texts(self, unit: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> None:
        h = np.zeros((len(begin), self.w.candidate.shape[0]), np.float32)
        for low in range(0, int(counts[0]), WINDOW):  # longest first
            going = counts > low
            begin, counts, h = begin[going], counts[going], h[going]
            at = low + np.arange(WINDOW)
            real = at < counts[:, None]
            u = unit[np.where(real, begin[:, None] + at, 0)]
            g, h, _ = gradients(self.w, h, u, real, self.cls_of, self.word_of)
            self._step(g)

    def _step(self, g: list[np.ndarray]) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g))
        clip = min(1.0, 1.0 / max(norm, 1e-6))
        for x, d, m in zip(self.w.arrays(), g, self.moments):
            if clip < 1:
                d *= clip  # the gradients are nobody else's
            m[0] *= 0.9
            m[0] += 0.1 * d
            m[1] *= 0.999
            d *= d
            d *= 0.001
            m[1] += d
            np.multiply(m[1], 1 / (1 - 0.999**self.steps), out=d)
            np.sqrt(d, out=d)
            d += 1e-8
            np.divide(m[0], d, out=d)
            d *= self.rate / (1 - 0.9**self.steps)
            x -= d


def mean(parts: list[Weights], shares: list[float]) -> Weights:
    """Weights averaged with the given shares, which add up to 1."""
    columns = zip(*[w.arrays() for w in parts])
    return Weights(*[sum(x.astype(np.float64) * s for x, s in zip(column, shares)).astype(column[0].dtype) for column in columns])
