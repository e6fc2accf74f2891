"""A character tagger in numpy: a two-way LSTM whose outputs a chain of label transitions (CRF) joins.

Windows of ``WIDTH`` characters are read at once. The first and the last label of a window are free, so
that a span may be cut by its edges; what windows that overlap say of a character is weighed by how far
it is from their edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WIDTH = 64
STRIDE = WIDTH // 2

#: Code points below 128 stand for themselves; then other letters, other signs, and no character at all.
LETTER, SIGN, NOTHING = 128, 129, 130
N_CHARS = 131

CHARS, STATES = 12, 24
EPOCHS, BATCH, RATE = 14, 48, 0.02


@dataclass
class Tagger:
    """Weights, and the kinds of span they know. Label 0 is outside; each kind has a first and an inner label."""

    kinds: tuple[str, ...]
    weights: dict[str, np.ndarray]

    def allowed(self) -> np.ndarray:
        return _allowed(len(self.kinds))


def char_classes(points: np.ndarray) -> np.ndarray:
    """What the tagger sees of code points."""
    high = points >= 128
    letters = high & (points >= 0xC0) & (points < 0x2000) | high & (points >= 0x3040) & (points < 0xFE00)
    return np.where(high, np.where(letters, LETTER, SIGN), points).astype(np.int16)


def _allowed(kinds: int) -> np.ndarray:
    """By label and next label: an inner label follows only the same kind."""
    labels = 2 * kinds + 1
    found = np.ones((labels, labels))
    for inner in range(2, labels, 2):
        found[:, inner] = 0
        found[[inner - 1, inner], inner] = 1
    return found


def _start(kinds: int, draw: np.random.Generator) -> dict[str, np.ndarray]:
    labels = 2 * kinds + 1

    def near(*shape: int) -> np.ndarray:
        return draw.normal(0, shape[-2] ** -0.5, shape)

    bias = np.zeros((2, 1, 4 * STATES))
    bias[:, :, STATES : 2 * STATES] = 1  # remember at first
    return {
        "chars": draw.normal(0, 0.5, (N_CHARS, CHARS)),
        "into": near(2, CHARS, 4 * STATES),
        "over": near(2, STATES, 4 * STATES),
        "bias": bias,
        "out": near(2 * STATES, labels),
        "out_bias": np.zeros(labels),
        "moves": np.zeros((labels, labels)),
    }


def _read(w: dict[str, np.ndarray], x: np.ndarray, keep: bool = False):
    """Emissions (place, window, label) of windows ``x`` (window, place); with ``keep`` also what learning needs."""
    n = len(x)
    seen = w["chars"][x].transpose(1, 0, 2)
    both = np.stack([seen, seen[::-1]])
    gates = both @ w["into"][:, None] + w["bias"][:, None]
    h = np.zeros((2, n, STATES), gates.dtype)
    c = np.zeros_like(h)
    states = np.empty((2, WIDTH, n, STATES), gates.dtype)
    cells, opened = [], []
    # The logistic function is half a hyperbolic tangent, so one call serves all four gates.
    half = np.full(4 * STATES, 0.5, gates.dtype)
    half[3 * STATES :] = 1
    for t in range(WIDTH):
        z = np.tanh((gates[:, t] + h @ w["over"]) * half)
        z[..., : 3 * STATES] = 0.5 * (z[..., : 3 * STATES] + 1)
        write, hold, show, new = (z[..., k * STATES : (k + 1) * STATES] for k in range(4))
        if keep:
            cells.append(c)
            opened.append(z)
        c = hold * c + write * new
        h = show * np.tanh(c)
        states[:, t] = h
    joined = np.concatenate([states[0], states[1][::-1]], axis=-1)
    emissions = joined @ w["out"] + w["out_bias"]
    return (emissions, both, states, cells, opened, joined) if keep else emissions


def _chain(emissions: np.ndarray, moves: np.ndarray):
    """Scaled forward and backward weights of the chain: forward, backward, exp(emissions), log of the sum."""
    top = emissions.max(axis=-1, keepdims=True)
    e = np.exp(emissions - top)
    forward, backward = np.empty_like(e), np.empty_like(e)
    scale = np.empty(e.shape[:2], e.dtype)
    now = e[0]
    for t in range(WIDTH):
        if t:
            now = (forward[t - 1] @ moves) * e[t]
        scale[t] = now.sum(axis=-1)
        forward[t] = now / scale[t][:, None]
    backward[-1] = 1
    for t in range(WIDTH - 1, 0, -1):
        backward[t - 1] = ((backward[t] * e[t]) @ moves.T) / scale[t][:, None]
    return forward, backward, e, scale, (np.log(scale).sum(axis=0) + top[..., 0].sum(axis=0))


def chances(tagger: Tagger, x: np.ndarray) -> np.ndarray:
    """The chance of each label at each place of each window (window, place, label)."""
    w = tagger.weights
    forward, backward, *_ = _chain(_read(w, x), np.exp(w["moves"]) * tagger.allowed())
    both = forward * backward
    return (both / both.sum(axis=-1, keepdims=True)).transpose(1, 0, 2)


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, allowed: np.ndarray):
    """Mean loss per window and the gradients of all weights."""
    n, labels = len(x), allowed.shape[0]
    emissions, both, states, cells, opened, joined = _read(w, x, keep=True)
    moves = np.exp(w["moves"]) * allowed
    forward, backward, e, scale, total = _chain(emissions, moves)
    said = y.T
    gold = np.take_along_axis(emissions, said[..., None], axis=-1)[..., 0].sum(axis=0)
    gold = gold + w["moves"][said[:-1], said[1:]].sum(axis=0)
    loss = (total - gold).mean()

    g = {}
    marginal = forward * backward
    marginal /= marginal.sum(axis=-1, keepdims=True)
    d_emit = marginal
    np.put_along_axis(d_emit, said[..., None], np.take_along_axis(d_emit, said[..., None], -1) - 1, -1)
    d_emit /= n
    right = backward[1:] * e[1:] / scale[1:][..., None]
    pairs = np.einsum("tbi,tbj->ij", forward[:-1], right) * moves
    np.add.at(pairs, (said[:-1].ravel(), said[1:].ravel()), -1)
    g["moves"] = pairs / n * allowed
    g["out"] = np.einsum("tbh,tbl->hl", joined, d_emit)
    g["out_bias"] = d_emit.sum(axis=(0, 1))
    d_joined = d_emit @ w["out"].T
    d_states = np.stack([d_joined[..., :STATES], d_joined[::-1][..., STATES:]])

    d_gates = np.empty((2, WIDTH, n, 4 * STATES))
    dh, dc = np.zeros((2, n, STATES)), np.zeros((2, n, STATES))
    for t in range(WIDTH - 1, -1, -1):
        z, before = opened[t], cells[t]
        write, hold, show, new = (z[..., k * STATES : (k + 1) * STATES] for k in range(4))
        bent = np.tanh(hold * before + write * new)
        dh = dh + d_states[:, t]
        dc = dc + dh * show * (1 - bent**2)
        parts = (dc * new * write * (1 - write), dc * before * hold * (1 - hold), dh * bent * show * (1 - show), dc * write * (1 - new**2))
        dz = d_gates[:, t] = np.concatenate(parts, axis=-1)
        dc = dc * hold
        dh = dz @ w["over"].transpose(0, 2, 1)
    before = np.zeros_like(states)
    before[:, 1:] = states[:, :-1]
    g["over"] = np.einsum("dtbh,dtbg->dhg", before, d_gates, optimize=True)
    g["into"] = np.einsum("dtbe,dtbg->deg", both, d_gates, optimize=True)
    g["bias"] = d_gates.sum(axis=(1, 2))[:, None]
    d_both = d_gates @ w["into"].transpose(0, 2, 1)[:, None]
    d_seen = d_both[0] + d_both[1][::-1]
    g["chars"] = np.zeros_like(w["chars"])
    np.add.at(g["chars"], x.T, d_seen)
    return loss, g


def train(
    examples: list[tuple[str, list[tuple[str, int, int]]]], kinds: tuple[str, ...], seed: int = 7, epochs: int = EPOCHS
) -> Tagger:
    """A tagger from texts of at most some windows' length and their labelled spans (kind, start, end).

    Every epoch cuts another window from each text. The same examples in the same order give the same weights.
    """
    draw = np.random.default_rng(seed)
    w = _start(len(kinds), draw)
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    encoded = [(char_classes(_points(text)), _labels(text, spans, kinds)) for text, spans in examples]
    allowed, step = _allowed(len(kinds)), 0
    steps = epochs * -(-len(encoded) // BATCH)
    for _ in range(epochs):
        order = draw.permutation(len(encoded))
        for at in range(0, len(order), BATCH):
            x, y = _cut([encoded[k] for k in order[at : at + BATCH]], draw)
            _, g = _gradients(w, x, y, allowed)
            size = np.sqrt(sum((v**2).sum() for v in g.values()))
            step += 1
            rate = RATE * (1 - 0.9 * step / steps)
            for k, v in g.items():
                v = v * min(1, 5 / (size + 1e-12))
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v**2
                w[k] = w[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return Tagger(kinds, {k: v.astype(np.float32) for k, v in w.items()})


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _labels(text: str, spans: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> np.ndarray:
    """A span that starts before the text is there with its inner label only."""
    found = np.zeros(len(text), np.int64)
    for kind, start, end in spans:
        label = 2 * kinds.index(kind) + 1
        found[max(start, 0) : end] = label + 1
        if start >= 0:
            found[start] = label
    return found


def _cut(parts: list[tuple[np.ndarray, np.ndarray]], draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    x = np.full((len(parts), WIDTH), NOTHING, np.int64)
    y = np.zeros((len(parts), WIDTH), np.int64)
    for n, (chars, labels) in enumerate(parts):
        skip = int(draw.integers(0, max(1, len(chars) - WIDTH + 1)))
        part = chars[skip : skip + WIDTH]
        lead = int(draw.integers(0, WIDTH - len(part) + 1))
        x[n, lead : lead + len(part)] = part
        y[n, lead : lead + len(part)] = labels[skip : skip + WIDTH]
    return x, y


def _windows(starts: np.ndarray, places: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """Text and number of the windows so many steps from that which begins in the stride of a place."""
    owner = np.searchsorted(starts, places, side="right") - 1
    grid = (places - starts[owner]) // STRIDE
    found = np.unique(np.concatenate([np.stack([owner, grid + k], 1) for k in steps]), axis=0)
    return found[(found[:, 1] >= -1) & (found[:, 1] * STRIDE < (starts[found[:, 0] + 1] - starts[found[:, 0]]))]


def _numbered(windows: np.ndarray) -> np.ndarray:
    """One number for a window's text and its own number, which is -1 at least."""
    return (windows[:, 0] << 32) + windows[:, 1] + 1


def tagged(
    tagger: Tagger, points: np.ndarray, starts: np.ndarray, marks: np.ndarray, at_once: int = 512
) -> Iterator[tuple[int, int, str, float]]:
    """Spans near marked places of texts that lie back to back: start, end, kind, mean chance.

    ``starts`` are the texts' starts and the end of the last. Windows stand ``STRIDE`` apart, counted
    from each text's start; those within a window's length of a mark are read, then those that any
    found span or its neighbours lie in, until there are no more. Spans that hold a mark are therefore
    those that reading every window would give. No span crosses texts.
    """
    if not len(marks):
        return
    done = np.empty((0, 2), np.int64)
    covered, total = np.empty(0, np.int64), np.empty((0, 2 * len(tagger.kinds) + 1), np.float32)
    weight = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(np.float32)
    wanted = _windows(starts, marks, (-2, -1, 0, 1))
    while len(wanted):
        done = np.concatenate([done, wanted])
        begin = starts[wanted[:, 0]] + wanted[:, 1] * STRIDE
        places = begin[:, None] + np.arange(WIDTH)
        inside = (places >= starts[wanted[:, 0]][:, None]) & (places < starts[wanted[:, 0] + 1][:, None])
        before, known = covered, total
        covered = np.union1d(before, places[inside])
        total = np.zeros((len(covered), known.shape[1]), np.float32)
        total[np.searchsorted(covered, before)] = known
        classes = char_classes(points[covered])
        for k in range(0, len(begin), at_once):
            here, real = places[k : k + at_once], inside[k : k + at_once]
            slot = np.searchsorted(covered, here)
            slot[~real] = 0
            x = np.where(real, classes[slot], NOTHING)
            found = chances(tagger, x.astype(np.int64)) * weight[None, :, None]
            np.add.at(total, slot[real], found[real])
        spoken = covered[total.argmax(axis=1) > 0]
        around = np.unique(np.concatenate([spoken - 1, spoken, spoken + 1]))
        wanted = _windows(starts, around[(around >= 0) & (around < len(points))], (-1, 0))
        wanted = wanted[~np.isin(_numbered(wanted), _numbered(done))]
    total /= total.sum(axis=1, keepdims=True)
    label = total.argmax(axis=1)
    kind = (label + 1) // 2
    text = np.searchsorted(starts, covered, side="right")
    breaks = np.ones(len(covered) + 1, bool)
    breaks[1:-1] = (np.diff(covered) != 1) | (np.diff(kind) != 0) | (np.diff(text) != 0) | (label[1:] % 2 == 1)
    edges = np.flatnonzero(breaks)
    sure = np.add.reduceat(total.max(axis=1), edges[:-1]) / np.diff(edges)
    for a, b, chance in zip(edges[:-1], edges[1:], sure, strict=True):
        if kind[a]:
            yield int(covered[a]), int(covered[b - 1]) + 1, tagger.kinds[kind[a] - 1], float(chance)
