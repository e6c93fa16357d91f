"""A small gated recurrent network in numpy with a class-factored output softmax.

A symbol is a class and a slot in it, ``symbol = cls * slots + slot``. The network reads symbols and
gives each next symbol P(class | state) * P(slot | class, state).
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
TRAIN_LANES = 256
TRAIN_STEPS = 16  # backpropagation is truncated to so many steps; the state goes on
SCORE_STEPS = 32
SCORE_ROWS = 100_000  # states that are sorted by class together
BLOCK = 1024  # states whose outputs are computed in one go, which a core's cache holds
STEEP = 60.0  # outputs of at most this size need no shift before they are exponentiated
RATE = 0.08
CLIP = 1.0

Params = dict[str, np.ndarray]


def initial(class_mass: np.ndarray, slot_mass: np.ndarray) -> Params:
    """Parameters that start as the unigram model of the given masses."""
    classes, slots = slot_mass.shape
    random = np.random.default_rng(7)
    share = (class_mass + 0.5) / (class_mass + 0.5).sum()
    within = (slot_mass + 1e-3) / (slot_mass + 1e-3).sum(axis=1, keepdims=True)
    return {
        "inputs": random.normal(0, 0.1, (classes * slots, 3 * HIDDEN)).astype(np.float32),
        "state": random.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)).astype(np.float32),
        "class_w": np.zeros((HIDDEN, classes), np.float32),
        "class_b": np.log(share).astype(np.float32),
        "slot_w": np.zeros((classes, slots, HIDDEN), np.float32),
        "slot_b": np.log(within).astype(np.float32),
    }


def _by_gate(rows: np.ndarray) -> np.ndarray:
    """``[gate, row, unit]``: update and reset gate, halved, and new state, each in one piece.

    The gates' logistic function is half a hyperbolic tangent at half the place, and a half.
    """
    out = np.ascontiguousarray(rows.reshape(-1, 3, HIDDEN).transpose(1, 0, 2))
    out[:2] *= 0.5
    return out


def _step(p: Params, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _move(_by_gate(p["inputs"][symbols]), _by_gate(p["state"]), h)


def _move(x: np.ndarray, state: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next state from the inputs' part ``x``, and the state's part; gates are left in ``x``."""
    u = h @ state
    gates, n = x[:2], x[2]
    gates += u[:2]
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    n += x[1] * u[2]
    np.tanh(n, out=n)
    onward = h - n
    onward *= x[0]
    onward += n
    return onward, u


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Rows in the order of their class, and ``(class, begin, end)`` in that order."""
    small = np.uint16 if cls.max(initial=0) < 1 << 16 else cls.dtype  # sorted by digits
    order = np.argsort(cls.astype(small), kind="stable")
    sizes = np.bincount(cls)
    names = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[names])
    return order, list(zip(names.tolist(), (ends - sizes[names]).tolist(), ends.tolist()))


def _with_one(h: np.ndarray) -> np.ndarray:
    """A column of ones beside ``h``: what it is multiplied with has the bias in its last row."""
    out = np.ones((len(h), h.shape[1] + 1), h.dtype)
    out[:, :-1] = h
    return out


def _output_weights(p: Params) -> tuple[np.ndarray, np.ndarray, bool, bool]:
    """Weights with their biases, of classes and of slots, and whether outputs need a shift."""
    return (
        np.concatenate([p["class_w"], p["class_b"][None]]),
        np.concatenate([p["slot_w"], p["slot_b"][:, :, None]], axis=2),
        _bound(p["class_w"], p["class_b"], 0) > STEEP, _bound(p["slot_w"], p["slot_b"], 2) > STEEP,
    )


def _bound(w: np.ndarray, b: np.ndarray, axis: int) -> float:
    """What no output exceeds in size, as no state does 1."""
    return float((np.abs(w).sum(axis=axis) + np.abs(b)).max(initial=0))


def _exp(x: np.ndarray, steep: bool) -> None:
    if steep:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)


def _picked(x: np.ndarray, column: np.ndarray, steep: bool) -> np.ndarray:
    """Softmax of one column in each row; ``x`` is used up."""
    _exp(x, steep)
    return x[np.arange(len(x)), column] / (x @ np.ones(x.shape[1], x.dtype))


def log_likelihood(p: Params, h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Natural log probability of each symbol, given the state before it."""
    slots = p["slot_b"].shape[1]
    cls, slot = symbols // slots, symbols % slots
    class_w, slot_w, class_steep, slot_steep = _output_weights(p)
    order, runs = _by_class(cls)
    h, cls, slot = _with_one(h[order]), cls[order], slot[order]
    shares = np.empty((2, len(h)), h.dtype)
    for at in range(0, len(h), BLOCK):
        own = slice(at, at + BLOCK)
        shares[0, own] = _picked(h[own] @ class_w, cls[own], class_steep)
    for c, begin, end in runs:
        for at in range(begin, end, BLOCK):
            own = slice(at, min(at + BLOCK, end))
            shares[1, own] = _picked(h[own] @ slot_w[c].T, slot[own], slot_steep)
    out = np.empty(len(h), h.dtype)
    out[order] = np.log(shares).sum(axis=0)
    return out


def score(p: Params, docs: list[np.ndarray], lanes: int = 4096) -> np.ndarray:
    """Log probability of each whole document: windows follow each other with the state carried."""
    total = np.zeros(len(docs))
    inputs, state = _by_gate(p["inputs"]), _by_gate(p["state"])
    order = np.argsort([-len(d) for d in docs], kind="stable")
    for at in range(0, len(order), lanes):
        own = order[at:at + lanes]
        sizes = np.array([len(docs[k]) for k in own])
        begins = np.cumsum(sizes) - sizes
        stream = np.concatenate([docs[k] for k in own])
        h = np.zeros((len(own), HIDDEN), np.float32)
        states, seen, lane_of, held = [], [], [], 0
        for start in range(0, int(sizes[0]), SCORE_STEPS):
            for at_step in range(start, min(start + SCORE_STEPS, int(sizes[0]))):
                n = int(np.searchsorted(-sizes, -at_step, side="left"))
                symbols = stream.take(begins[:n] + at_step)
                states.append(h[:n])
                seen.append(symbols)
                lane_of.append(own[:n])
                held += n
                h, _ = _move(inputs.take(symbols, axis=1), state, h[:n])
            if held >= SCORE_ROWS or start + SCORE_STEPS >= sizes[0]:
                logs = log_likelihood(p, np.concatenate(states), np.concatenate(seen))
                total += np.bincount(np.concatenate(lane_of), logs, minlength=len(docs))
                states, seen, lane_of, held = [], [], [], 0
    return total


def train(p: Params, docs: list[np.ndarray], least_updates: int) -> Params:
    """Adagrad over windows of all ``docs``, lane by lane, at least ``least_updates`` times."""
    p = {k: v.copy() for k, v in p.items()}
    docs = [d for d in docs if len(d)]
    if not docs:
        return p
    memory = {k: np.full(v.shape, 1e-2, np.float32) for k, v in p.items()}
    stream = np.concatenate(docs)
    first = np.zeros(len(stream), bool)
    first[np.cumsum([0, *(len(d) for d in docs[:-1])])] = True
    lanes = max(1, min(TRAIN_LANES, len(stream) // TRAIN_STEPS))
    length = len(stream) // lanes
    grid = stream[:lanes * length].reshape(lanes, length).T
    begins = first[:lanes * length].reshape(lanes, length).T
    windows = max(1, length // TRAIN_STEPS)
    passes = max(1, -(-least_updates // windows))
    for _ in range(passes):
        h = np.zeros((lanes, HIDDEN), np.float32)
        for start in range(0, length, TRAIN_STEPS):
            part = slice(start, start + TRAIN_STEPS)
            h = _update(p, memory, grid[part], begins[part], h)
    return p


def _update(p: Params, memory: Params, grid, begins, h: np.ndarray) -> np.ndarray:
    steps, lanes = grid.shape
    symbols = grid.reshape(-1)
    state = _by_gate(p["state"])
    x = _by_gate(p["inputs"].take(symbols, axis=0)).reshape(3, steps, lanes, HIDDEN)
    un = np.empty((steps, lanes, HIDDEN), np.float32)
    states = np.empty_like(un)
    fresh = begins.any(axis=1).tolist()
    for t in range(steps):
        if fresh[t]:  # a document starts from nothing
            h = np.where(begins[t][:, None], np.float32(0), h)
        states[t] = h
        h, u = _move(x[:, t], state, h)
        un[t] = u[2]
    d_states, grads = _output_gradients(p, states.reshape(-1, HIDDEN), symbols)
    scale = np.float32(1.0 / lanes)
    d_states = d_states.reshape(steps, lanes, HIDDEN)
    # What a state's gradient is multiplied with, of all steps at once.
    z, r, n = x
    to_n = (1 - z) * (1 - n * n)
    d_inner = np.empty_like(x)
    np.multiply((states - n) * z, 1 - z, out=d_inner[0])
    np.multiply(to_n * un * r, 1 - r, out=d_inner[1])
    np.multiply(to_n, r, out=d_inner[2])
    back = np.ascontiguousarray(p["state"].reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0))
    d_h = np.zeros((lanes, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        own = d_inner[:, t]
        own *= d_h
        to_n[t] *= d_h
        d_h = d_h * z[t]
        for part in own @ back:
            d_h += part
        d_h += d_states[t]
        if fresh[t]:
            d_h[begins[t]] = 0
    d_inner = d_inner.reshape(3, -1, HIDDEN)
    d_state = states.reshape(-1, HIDDEN).T @ d_inner
    grads["state"] = d_state.transpose(1, 0, 2).reshape(HIDDEN, 3 * HIDDEN)
    for name, g in grads.items():
        _adagrad(p[name], memory[name], g * scale)
    d_inner[2] = to_n.reshape(-1, HIDDEN)  # now the inputs' gradients
    names, g = _sums_by(symbols, d_inner)
    g *= scale
    np.clip(g, -CLIP, CLIP, out=g)
    seen = memory["inputs"][names] + g * g
    memory["inputs"][names] = seen
    p["inputs"][names] -= RATE * g / np.sqrt(seen)
    return h


def _sums_by(symbols: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that occur, and for each the sum of its rows in ``[gate, row, unit]``, in a row."""
    place = np.bincount(symbols)
    names = np.flatnonzero(place)
    place[names] = np.arange(len(names))
    gates, _, units = parts.shape
    width = gates * units
    cells = (place[symbols] * width)[:, None] + np.arange(width).reshape(gates, 1, units)
    sums = np.bincount(cells.reshape(-1), parts.reshape(-1), len(names) * width)
    return names, sums.reshape(-1, width).astype(parts.dtype)


def _adagrad(value: np.ndarray, memory: np.ndarray, g: np.ndarray) -> None:
    np.clip(g, -CLIP, CLIP, out=g)
    memory += g * g
    value -= RATE * g / np.sqrt(memory)


def _wrong(x: np.ndarray, column: np.ndarray, steep: bool) -> None:
    """Turn outputs into their softmax, less one at the column that was right."""
    _exp(x, steep)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    x[np.arange(len(x)), column] -= 1


def _output_gradients(p: Params, h: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, Params]:
    slots = p["slot_b"].shape[1]
    class_w, slot_w, class_steep, slot_steep = _output_weights(p)
    order, runs = _by_class(symbols // slots)
    symbols = symbols[order]
    rows = _with_one(h[order])
    cls, slot = symbols // slots, symbols % slots
    class_g = np.zeros_like(class_w)
    d_rows = np.empty_like(h)
    for at in range(0, len(rows), BLOCK):
        own = slice(at, at + BLOCK)
        wrong = rows[own] @ class_w
        _wrong(wrong, cls[own], class_steep)
        class_g += rows[own].T @ wrong
        np.matmul(wrong, class_w[:-1].T, out=d_rows[own])
    # Rows lie by class: each class is multiplied by itself, all else is done over all rows at once.
    off = np.empty((len(rows), slots), rows.dtype)
    for c, begin, end in runs:
        np.matmul(rows[begin:end], slot_w[c].T, out=off[begin:end])
    _wrong(off, slot, slot_steep)
    slot_g = np.zeros_like(slot_w)
    for c, begin, end in runs:
        own = off[begin:end]
        np.matmul(own.T, rows[begin:end], out=slot_g[c])
        d_rows[begin:end] += own @ p["slot_w"][c]
    d_h = np.empty_like(d_rows)
    d_h[order] = d_rows
    return d_h, {
        "class_w": class_g[:-1], "class_b": class_g[-1],
        "slot_w": slot_g[:, :, :-1], "slot_b": slot_g[:, :, -1],
    }
