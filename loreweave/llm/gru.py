"""A gated recurrent language model in numpy with a class-factored output.

The output is a class and then a word: frequent words stand in classes of equal
size with a softmax of their own, all other words in tail classes, inside which
counts decide. Training is truncated backpropagation over windows with the state
carried from one to the next; scoring carries the state through whole documents.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
#: Frequent words, words per class of them, and tail classes.
HEAD, PER_CLASS, TAILS = 1024, 32, 32
#: Steps per window, and lanes when training and at most when scoring.
WINDOW, LANES, MOST_LANES = 32, 256, 512
RATE = 0.08
#: Tokens whose outputs are worked on together, so that they stay in the cache, and tokens scored at a time.
CACHED, SCORED = 2048, 16_384
#: Logits up to this size need no shift before ``exp``, whose sums then neither overflow nor vanish.
REACH = 60.0


@dataclass(frozen=True)
class Shape:
    """Token ids: frequent words by count, then the tail classes, then the start mark."""

    head: int
    tails: int = TAILS
    hidden: int = HIDDEN

    @property
    def blocks(self) -> int:
        return -(-self.head // PER_CLASS)

    @property
    def start(self) -> int:
        return self.head + self.tails


Params = dict[str, np.ndarray]


def initial(shape: Shape, head_counts: np.ndarray, tail_counts: np.ndarray, seed: int = 1) -> Params:
    """Small weights, and biases that make the untrained model the unigram model."""
    rng = np.random.default_rng(seed)
    h = shape.hidden

    def small(*size: int) -> np.ndarray:
        return (rng.standard_normal(size) * 0.1).astype(np.float32)

    padded = np.zeros(shape.blocks * PER_CLASS)
    padded[: shape.head] = head_counts + 1
    by_block = padded.reshape(shape.blocks, PER_CLASS)
    classes = np.concatenate([by_block.sum(axis=1), tail_counts + 1])
    with np.errstate(divide="ignore"):
        inside = np.maximum(np.log(by_block / by_block.sum(axis=1, keepdims=True)), -1e9)
    return {
        "inputs": small(shape.start + 1, 3 * h),
        "inner": small(h, 3 * h),
        "bias": np.zeros(3 * h, np.float32),
        "classes": small(h, shape.blocks + shape.tails),
        "class_bias": np.log(classes / classes.sum()).astype(np.float32),
        "words": small(shape.blocks, h, PER_CLASS),
        "word_bias": inside.astype(np.float32),
    }


def flat(params: Params) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in sorted(params)])


def unflat(values: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _by_step(values: np.ndarray) -> np.ndarray:
    """``[unit, step, lane]`` as ``[step, unit, lane]``, so that a step is one block of memory."""
    return np.ascontiguousarray(values.transpose(1, 0, 2))


def _by_unit(values: np.ndarray) -> np.ndarray:
    """``[step, unit, lane]`` as ``[unit, token]``."""
    return np.ascontiguousarray(values.transpose(1, 0, 2)).reshape(values.shape[1], -1)


class Room:
    """Arrays that are used again: what a step does costs less than fresh memory for its results."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *size: int, kind: type = np.float32) -> np.ndarray:
        found = self.held.get(name)
        if found is None or found.shape != size:
            found = self.held[name] = np.empty(size, kind)
        return found


class Ready:
    """The weights as the passes take them, and the room they work in.

    The gates' weights are halved, as the logistic function is half a tanh of half its argument.
    Outputs are ``[output, unit]`` for states with a last unit that is always one, whose weights
    are biases. The greatest bias becomes 0, which changes no softmax; states lie between -1 and 1,
    so every logit is at least minus the sum of its weights.
    """

    def __init__(self, p: Params, room: Room) -> None:
        self.room, size = room, len(p["inner"])
        self.table = room("table", 3 * size, len(p["inputs"]))
        np.add(p["inputs"].T, p["bias"][:, None], out=self.table)
        self.table[: 2 * size] *= 0.5
        self.inner = np.ascontiguousarray(p["inner"].T)
        self.inner[: 2 * size] *= 0.5
        self.classes, self.words = _weights(p["classes"], p["class_bias"]), _weights(p["words"], p["word_bias"])


def _states(p: Params, tokens: np.ndarray, h: np.ndarray, start: int, ready: Ready | None = None, keep: dict | None = None):
    """States after each of ``tokens[step, lane]``, as ``[unit, token]``, and the last one as ``[unit, lane]``.

    A start mark empties the state before it. Tokens come last everywhere, so
    sums over units or classes run over rows of memory. ``keep`` gets what the way back needs.
    """
    ready = ready or Ready(p, Room())
    room, size, (steps, lanes) = ready.room, len(h), tokens.shape
    at, empty = tokens.astype(np.intp), tokens == start
    some = empty.any(axis=1)
    out, inner = room("states", steps, size, lanes), room("inner", 3 * size, lanes)
    gates, moved = room("gates", 1 if keep is None else steps, 3 * size, lanes), room("moved", size, lanes)
    if keep is not None:
        keep |= {"gates": gates, "before": room("before", steps, size, lanes), "inner": room("inner_n", steps, size, lanes)}
    for t in range(steps):
        if some[t]:
            h = h * ~empty[t]
        g, gate = np.matmul(ready.inner, h, out=inner), gates[t % len(gates)]
        np.take(ready.table, at[t], axis=1, out=gate, mode="clip")
        rz, n = gate[: 2 * size], gate[2 * size :]
        rz += g[: 2 * size]
        np.tanh(rz, out=rz)
        rz *= 0.5
        rz += 0.5
        if keep is not None:
            keep["before"][t], keep["inner"][t] = h, g[2 * size :]
        n += np.multiply(rz[:size], g[2 * size :], out=moved)
        np.tanh(n, out=n)
        h = np.subtract(h, n, out=out[t])
        h *= rz[size:]
        h += n
    return _by_unit(out), h.copy()


def _with_one(states: np.ndarray, room: Room) -> np.ndarray:
    """``states`` with a last unit that is always one, whose weights are biases."""
    out = room("with one", len(states) + 1, states.shape[1])
    out[:-1] = states
    out[-1] = 1
    return out


def _weights(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, bool]:
    """Weights of ``Ready``, and whether every logit is small."""
    reach = np.abs(weights).sum(axis=-2).max()
    least = (bias - bias.max(axis=-1, keepdims=True))[..., None]
    return np.concatenate([weights.swapaxes(-1, -2), least], axis=-1), bool(reach < REACH)


def _chosen(logits: np.ndarray, small: bool, at: np.ndarray) -> np.ndarray:
    """Log probability of one entry of each column."""
    if not small:
        logits -= logits.max(axis=0)
    own = logits[at, np.arange(len(at))]
    np.exp(logits, out=logits)
    return own - np.log(logits.sum(axis=0))


def _slope(logits: np.ndarray, small: bool, at: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Gradient of the negative log probability of one entry of each column, times ``scale``."""
    if not small:
        logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits *= scale / logits.sum(axis=0)
    logits[at, np.arange(len(at))] -= scale
    return logits


def _class_of(ids: np.ndarray, shape: Shape) -> np.ndarray:
    return np.where(ids < shape.head, ids // PER_CLASS, ids - shape.head + shape.blocks)


def _blocks(classes: np.ndarray, shape: Shape) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Tokens of frequent words in the order of their blocks, and each block's part of it."""
    order = np.argsort(classes.astype(np.int16), kind="stable")
    ends = np.searchsorted(classes[order], np.arange(shape.blocks + 1))
    parts = [(k, slice(ends[k], ends[k + 1])) for k in range(shape.blocks) if ends[k] < ends[k + 1]]
    return order[: ends[-1]], parts


def _inside(ready: Ready, states: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """Logits ``[place, token]`` of the words of each token's block."""
    logits = np.empty((PER_CLASS, states.shape[1]), np.float32)
    for k, part in parts:
        np.matmul(ready.words[0][k], states[:, part], out=logits[:, part])
    return logits


def log_probabilities(p: Params, shape: Shape, states: np.ndarray, ids: np.ndarray, ready: Ready | None = None) -> np.ndarray:
    """Natural log probability of each id; of a tail word, that of its class. ``states`` is ``[unit, token]``."""
    ready = ready or Ready(p, Room())
    classes = _class_of(ids, shape)
    states = _with_one(states, ready.room)
    out = np.empty(len(ids), np.float32)
    weights, small = ready.classes
    for at in range(0, len(ids), CACHED):
        some = states[:, at : at + CACHED]
        logits = np.matmul(weights, some, out=ready.room("logits", len(weights), some.shape[1]))
        out[at : at + CACHED] = _chosen(logits, small, classes[at : at + CACHED])
    order, parts = _blocks(classes, shape)
    logits = _inside(ready, np.take(states, order, axis=1), parts)
    out[order] += _chosen(logits, ready.words[1], ids[order] % PER_CLASS)
    return out


class Trainer:
    """Adagrad over windows."""

    def __init__(self, params: Params, shape: Shape) -> None:
        self.p = {k: v.copy() for k, v in params.items()}
        self.shape = shape
        self.seen = {k: np.full_like(v, 1e-8) for k, v in params.items()}
        self.room = Room()

    def stream(self, ids: np.ndarray, lanes: int = LANES, window: int = WINDOW) -> None:
        """Learns from documents that follow each other, each behind a start mark."""
        if len(ids) < 2:
            return
        lanes = max(1, min(lanes, len(ids) // window))
        steps = -(-len(ids) // lanes)
        padded = np.full(steps * lanes, self.shape.start, ids.dtype)
        padded[: len(ids)] = ids
        table = padded.reshape(lanes, steps).T
        h = np.zeros((self.shape.hidden, lanes), np.float32)
        for at in range(0, steps - 1, window):
            inputs = table[at : min(at + window, steps - 1)]
            h = self.window(inputs, table[at + 1 : at + 1 + len(inputs)], h)

    def window(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray) -> np.ndarray:
        p, shape, size, room = self.p, self.shape, self.shape.hidden, self.room
        ready, keep = Ready(p, room), {}
        states, last = _states(p, inputs, h, shape.start, ready, keep)
        ids = targets.ravel()
        real = ids != shape.start
        count = max(1, int(real.sum()))
        ids = np.where(real, ids, 0)
        classes = _class_of(ids, shape)
        scale = (real / np.float32(count)).astype(np.float32)
        states, d_states = _with_one(states, room), room("d states", size, len(ids))
        weights, small = ready.classes
        found = np.zeros((len(weights), size + 1), np.float32)
        for at in range(0, len(ids), CACHED):
            piece = slice(at, at + CACHED)
            some = states[:, piece]
            logits = np.matmul(weights, some, out=room("logits", len(weights), some.shape[1]))
            d = _slope(logits, small, classes[piece], scale[piece])
            found += d @ some.T
            np.matmul(p["classes"], d, out=d_states[:, piece])
        grads = {"classes": found[:, :-1].T, "class_bias": found[:, -1]}
        order, parts = _blocks(classes, shape)
        some = np.take(states, order, axis=1)
        d = _slope(_inside(ready, some, parts), ready.words[1], ids[order] % PER_CLASS, scale[order])
        found = np.zeros((shape.blocks, PER_CLASS, size + 1), np.float32)
        d_some = np.zeros((size, len(order) + 1), np.float32)  # the last place for tokens without a block
        for k, part in parts:
            np.matmul(d[:, part], some[:, part].T, out=found[k])
            np.matmul(p["words"][k], d[:, part], out=d_some[:, part])
        place = np.full(len(ids), len(order))
        place[order] = np.arange(len(order))
        d_states += np.take(d_some, place, axis=1, out=room("d some", size, len(ids)), mode="clip")
        grads |= {"words": found[:, :, :-1].swapaxes(1, 2), "word_bias": found[:, :, -1]}
        d_gates = self.back(inputs == shape.start, d_states, keep)
        # The state before sees the inner product of the new state, the token the new state itself.
        grads["inner"] = np.matmul(keep["before"], d_gates[:, : 3 * size].transpose(0, 2, 1)).sum(axis=0)
        tokens, row = inputs.ravel().astype(np.intp), room("row", *inputs.shape, kind=np.float64)
        used = np.flatnonzero(np.bincount(tokens))
        summed = np.empty((len(used), 3 * size))
        for k, unit in enumerate([*range(2 * size), *range(3 * size, 4 * size)]):
            row[...] = d_gates[:, unit]
            summed[:, k] = np.bincount(tokens, row.ravel())[used]
        grads["bias"] = summed.sum(axis=0)
        for k, g in grads.items():
            self.step(k, slice(None), np.clip(g, -1, 1))
        self.step("inputs", used, summed.astype(np.float32))
        return last

    def back(self, empty: np.ndarray, d_states: np.ndarray, keep: dict) -> np.ndarray:
        """``[step, unit, lane]``: gradients of the reset and update gate, the new state's inner product and the new state."""
        (steps, lanes), size, room = empty.shape, self.shape.hidden, self.room
        d_states, some = _by_step(d_states.reshape(size, steps, lanes)), empty.any(axis=1)
        out, moved, product = room("d gates", steps, 4 * size, lanes), room("moved", size, lanes), room("product", size, lanes)
        carry = np.zeros((size, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            r, z, n = keep["gates"][t].reshape(3, size, lanes)
            dr, dz, dg, dn = out[t].reshape(4, size, lanes)
            carry += d_states[t]
            np.subtract(1, z, out=moved)
            np.multiply(carry, moved, out=dn)
            carry *= z
            np.subtract(keep["before"][t], n, out=dz)
            dz *= carry
            dz *= moved
            np.multiply(n, n, out=moved)
            dn *= np.subtract(1, moved, out=moved)
            np.multiply(dn, r, out=dg)
            np.subtract(1, r, out=moved)
            np.multiply(dg, moved, out=dr)
            dr *= keep["inner"][t]
            carry += np.matmul(self.p["inner"], out[t, : 3 * size], out=product)
            if some[t]:
                carry *= ~empty[t]
        return out

    def step(self, k: str, at, g: np.ndarray) -> None:
        seen = self.seen[k][at]
        seen += g * g
        self.seen[k][at] = seen
        self.p[k][at] -= RATE * g / np.sqrt(seen)


def score_documents(p: Params, shape: Shape, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each whole document of token ids.

    Documents are dealt to lanes, longest first, each lane one document after
    the other; a lane's state runs through a document across all windows.
    """
    sizes = np.array([len(d) for d in docs], np.int64)
    total = np.zeros(len(docs))
    if not sizes.sum():
        return total
    lanes = int(min(MOST_LANES, len(docs), max(1, sizes.sum() // sizes.max())))
    heap = [(0, k) for k in range(lanes)]
    dealt: list[list[int]] = [[] for _ in range(lanes)]
    for i in np.argsort(-sizes, kind="stable"):
        if sizes[i]:
            used, k = heapq.heappop(heap)
            dealt[k].append(int(i))
            heapq.heappush(heap, (used + int(sizes[i]), k))
    steps = max(used for used, _ in heap)
    inputs = np.full((lanes, steps), shape.start, np.int32)
    targets = np.zeros((lanes, steps), np.int32)
    owner = np.full((lanes, steps), len(docs), np.int32)
    for k, mine in enumerate(dealt):
        at = 0
        for i in mine:
            n = sizes[i]
            targets[k, at : at + n] = docs[i]
            inputs[k, at + 1 : at + n] = docs[i][:-1]
            owner[k, at : at + n] = i
            at += n
    inputs, targets, owner = inputs.T, targets.T, owner.T
    h = np.zeros((shape.hidden, lanes), np.float32)
    sums = np.zeros(len(docs) + 1)
    window, ready = max(WINDOW, SCORED // lanes), Ready(p, Room())
    for at in range(0, steps, window):
        states, h = _states(p, np.ascontiguousarray(inputs[at : at + window]), h, shape.start, ready)
        found = log_probabilities(p, shape, states, targets[at : at + window].ravel(), ready)
        sums += np.bincount(owner[at : at + window].ravel(), found, len(docs) + 1)
    return sums[:-1]
