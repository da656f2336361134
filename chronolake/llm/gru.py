"""A small gated recurrent network over word ids in numpy, with a class-factored softmax.

The output is a class (softmax over all classes) and, for classes with listed words, a word of the class
(softmax over its MEMBERS words). Classes without listed words stand for sets of rare words.
"""

from __future__ import annotations

import ctypes
import functools

import numpy as np

HIDDEN = 24
EMBEDDING = 16
MEMBERS = 32  # words of a class
WINDOW = 16  # steps of truncated backpropagation
STREAMS = 256  # texts that are learned from side by side
SCORED = 1024  # texts that are scored side by side
BLOCK = 512  # columns of a softmax at a time, for the processor's cache
RATE = 0.01

Weights = dict[str, np.ndarray]

_SETTERS = ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads")


@functools.cache
def one_thread() -> int:
    """Keep numpy's OpenBLAS of this process to one thread; the number of libraries so set.

    The products here are small, and Spark already runs a task on each core: by default OpenBLAS starts a
    thread for every core of the machine in every Python worker, and they spin, burning about ten times the
    processor time of the work itself. One thread also makes the sums the same on any machine.
    """
    try:
        with open("/proc/self/maps") as maps:
            paths = {line.split()[-1] for line in maps if "openblas" in line.lower() and line.rstrip().endswith(".so")}
    except OSError:
        return 0
    done = 0
    for path in sorted(paths):
        library = ctypes.CDLL(path)
        for name in _SETTERS:
            if hasattr(library, name):
                getattr(library, name)(1)
                done += 1
                break
    return done


def initial(counts: np.ndarray, listed: int) -> Weights:
    """Random weights whose biases give the frequencies ``counts``: listed words first, then rare classes."""
    random = np.random.default_rng(0)
    classes = listed // MEMBERS
    rare = len(counts) - listed
    words = counts[:listed].reshape(classes, MEMBERS) + 1e-3
    by_class = np.concatenate([words.sum(1), counts[listed:] + 1e-3])

    def normal(*shape):
        return (random.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)

    return {
        "emb": 0.1 * normal(len(counts), EMBEDDING) * np.sqrt(len(counts)).astype(np.float32),
        "wx": normal(EMBEDDING, 3 * HIDDEN),
        "b": np.zeros(3 * HIDDEN, dtype=np.float32),
        "u": normal(HIDDEN, 3 * HIDDEN),
        "wc": 0.1 * normal(HIDDEN, classes + rare),
        "bc": np.log(by_class / by_class.sum()).astype(np.float32),
        "wv": 0.1 * normal(classes, HIDDEN, MEMBERS),
        "bv": np.log(words / words.sum(1, keepdims=True)).astype(np.float32),
    }


def _advance(h: np.ndarray, given: np.ndarray, u: np.ndarray):
    """One step of the network, a column for each text; also what backpropagation needs of it."""
    own = u @ h
    gates = 1 / (1 + np.exp(-(given[: 2 * HIDDEN] + own[: 2 * HIDDEN])))
    keep, reset = gates[:HIDDEN], gates[HIDDEN:]
    fresh = np.tanh(given[2 * HIDDEN :] + reset * own[2 * HIDDEN :])
    return fresh + keep * (h - fresh), (keep, reset, fresh, own[2 * HIDDEN :])


def _step(h: np.ndarray, given: np.ndarray, u: np.ndarray):
    """As ``_advance``, a row for each text."""
    h, kept = _advance(h.T, given.T, u.T)
    return h.T, tuple(part.T for part in kept)


def _classes(w: Weights, targets: np.ndarray) -> np.ndarray:
    listed = w["bv"].size
    return np.where(targets < listed, targets // MEMBERS, targets - listed + len(w["bv"]))


class _Members:
    """Targets that are listed words, sorted by class, and the logits of their classes' words."""

    def __init__(self, w: Weights, states: np.ndarray, targets: np.ndarray, classes: np.ndarray):
        order = np.argsort(classes.astype(np.int16), kind="stable")
        self.edges = np.searchsorted(classes[order], np.arange(len(w["bv"]) + 1))
        self.rows = order[: self.edges[-1]]
        own = classes[self.rows]
        self.at = (targets[self.rows] - own * MEMBERS, np.arange(len(self.rows)))
        self.states = states[:, self.rows]
        self.logits = np.take(w["bv"].T, own, axis=1)
        for c, part in self.parts():
            self.logits[:, part] += w["wv"][c].T @ self.states[:, part]

    def parts(self):
        """(class, its columns) for each class among the targets."""
        for c in range(len(self.edges) - 1):
            if self.edges[c] < self.edges[c + 1]:
                yield c, slice(self.edges[c], self.edges[c + 1])


def _normalise(x: np.ndarray, at: tuple[np.ndarray, np.ndarray], scale: float = 1) -> np.ndarray:
    """Turn logits by column into probabilities times ``scale``, in place; the log probabilities at ``at``."""
    logs = np.empty(x.shape[1], x.dtype)
    for start in range(0, len(logs), BLOCK):
        block = slice(start, start + BLOCK)
        part = x[:, block]
        part -= part.max(0)
        logs[block] = x[at[0][block], at[1][block]]
        np.exp(part, out=part)
        sums = part.sum(0)
        logs[block] -= np.log(sums)
        part *= x.dtype.type(scale) / sums
    return logs


def _class_logits(w: Weights, states: np.ndarray) -> np.ndarray:
    logits = w["wc"].T @ states
    logits += w["bc"][:, None]
    return logits


def _log_probabilities(w: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    classes = _classes(w, targets)
    result = _normalise(_class_logits(w, states), (classes, np.arange(len(targets))))
    members = _Members(w, states, targets, classes)
    if len(members.rows):
        result[members.rows] += _normalise(members.logits, members.at)
    return result


def log_probabilities(w: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target after its state (a row each)."""
    return _log_probabilities(w, states.T, targets)


def _gradients(w: Weights, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, end: int):
    """Loss, gradients and last state of one window (steps x streams); a state starts anew at ``end``.

    Inside, features are rows and tokens are columns, steps one after the other.
    """
    steps, streams = inputs.shape
    came, goal = inputs.reshape(-1), targets.reshape(-1)
    n = len(goal)
    given = np.take((w["emb"] @ w["wx"] + w["b"]).T, came, axis=1)
    kind, ut = given.dtype, np.ascontiguousarray(w["u"].T)
    before, states = np.empty((HIDDEN, n), kind), np.empty((HIDDEN, n), kind)
    keep, reset, fresh, own = (np.empty((HIDDEN, n), kind) for _ in range(4))
    goes_on = (came != end).astype(kind)
    h = h.T
    columns = [slice(t * streams, (t + 1) * streams) for t in range(steps)]
    for at in columns:
        h = h * goes_on[at]
        before[:, at] = h
        h, (keep[:, at], reset[:, at], fresh[:, at], own[:, at]) = _advance(h, given[:, at], ut)
        states[:, at] = h

    classes = _classes(w, goal)
    g = {name: np.zeros_like(value) for name, value in w.items()}
    scale = kind.type(1 / n)
    error, right = _class_logits(w, states), (classes, np.arange(n))
    loss = -_normalise(error, right, scale).sum()
    error[right] -= scale  # slopes by the logits
    g["wc"], g["bc"] = states @ error.T, error.sum(1)
    back = w["wc"] @ error
    members = _Members(w, states, goal, classes)
    if len(members.rows):
        error = members.logits
        loss -= _normalise(error, members.at, scale).sum()
        error[members.at] -= scale
        inner = np.empty_like(members.states)
        for c, part in members.parts():
            g["wv"][c], g["bv"][c] = members.states[:, part] @ error[:, part].T, error[:, part].sum(1)
            inner[:, part] = w["wv"][c] @ error[:, part]
        back[:, members.rows] += inner

    by_fresh = (1 - keep) * (1 - fresh * fresh)
    by_keep = (before - fresh) * keep * (1 - keep)
    by_reset = own * reset * (1 - reset)
    d_given, d_own = np.empty((3 * HIDDEN, n), kind), np.empty((3 * HIDDEN, n), kind)
    later = np.zeros((HIDDEN, streams), kind)
    for at in reversed(columns):
        d = back[:, at] + later
        d_fresh = d * by_fresh[:, at]
        d_given[:HIDDEN, at] = d * by_keep[:, at]
        d_given[HIDDEN : 2 * HIDDEN, at] = d_fresh * by_reset[:, at]
        d_given[2 * HIDDEN :, at] = d_fresh
        d_own[: 2 * HIDDEN, at] = d_given[: 2 * HIDDEN, at]
        d_own[2 * HIDDEN :, at] = d_fresh * reset[:, at]
        later = (d * keep[:, at] + w["u"] @ d_own[:, at]) * goes_on[at]
    g["u"] = before @ d_own.T
    g["b"] = d_given.sum(1)
    g["wx"] = np.take(w["emb"].T, came, axis=1) @ d_given.T
    d_emb = w["wx"] @ d_given
    for i in range(EMBEDDING):
        g["emb"][:, i] = np.bincount(came, weights=d_emb[i], minlength=len(w["emb"]))
    return loss / n, g, h.T


class Learner:
    """Weights and Adam's moments that go on learning, text by text; ``done`` windows so far."""

    def __init__(self, w: Weights, first: Weights | None = None, second: Weights | None = None, done: float = 0):
        self.w = dict(w)
        self.first = first or {name: np.zeros_like(value) for name, value in w.items()}
        self.second = second or {name: np.zeros_like(value) for name, value in w.items()}
        self.done = done

    def learn(self, texts: list[np.ndarray], end: int, rate: float) -> int:
        """One pass over texts given as ids, each closed by ``end``, in windows; the number of ids predicted."""
        one_thread()
        stream = np.concatenate([np.array([end]), *texts])
        streams = min(STREAMS, max(1, (len(stream) - 1) // (4 * WINDOW)))
        length = -(-(len(stream) - 1) // streams)
        n = streams * length
        whole = np.concatenate([stream, stream[1 : n + 2 - len(stream)]])  # the last stream goes on with the first ids
        inputs, targets = whole[:n].reshape(streams, length).T, whole[1 : n + 1].reshape(streams, length).T
        h = np.zeros((streams, HIDDEN), dtype=np.float32)
        for at in range(0, length, WINDOW):
            _, g, h = _gradients(self.w, h, inputs[at : at + WINDOW], targets[at : at + WINDOW], end)
            self._step(g, rate)
        return len(stream) - 1

    def _step(self, g: Weights, rate: float) -> None:
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        clip = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        self.done += 1
        a, b = 1 - 0.9**self.done, 1 - 0.99**self.done
        for name, x in g.items():
            x = x * clip
            self.first[name] += np.float32(0.1) * (x - self.first[name])
            self.second[name] += np.float32(0.01) * (x * x - self.second[name])
            step = self.first[name] / np.float32(a) / (np.sqrt(self.second[name] / np.float32(b)) + np.float32(1e-8))
            self.w[name] = self.w[name] - np.float32(rate) * step

    def flat(self) -> np.ndarray:
        """All numbers in one row: weights, both moments, ``done``."""
        parts = [part[name].ravel() for part in (self.w, self.first, self.second) for name in sorted(self.w)]
        return np.concatenate([*parts, [self.done]]).astype(np.float64)

    @staticmethod
    def unflat(values: np.ndarray, like: Weights) -> Learner:
        parts, at = [], 0
        for _ in range(3):
            part = {}
            for name in sorted(like):
                size = like[name].size
                part[name] = values[at : at + size].reshape(like[name].shape).astype(np.float32)
                at += size
            parts.append({name: part[name] for name in like})
        return Learner(*parts, done=float(values[at]))


def score(w: Weights, texts: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log probability of each whole text (ids closed by ``end``).

    Texts of like length run side by side, window by window; states are carried from window to window, so
    every word is predicted from the whole text before it.
    """
    one_thread()
    given, ut = (w["emb"] @ w["wx"] + w["b"]).T, np.ascontiguousarray(w["u"].T)
    total = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for at in range(0, len(order), SCORED):
        some = order[at : at + SCORED]  # longest first: finished texts leave at the end
        lengths = np.array([len(texts[i]) for i in some])
        h = np.zeros((HIDDEN, len(some)), dtype=np.float32)
        last = np.full(len(some), end)
        sums = np.zeros(len(some))
        for start in range(0, lengths[0], WINDOW // 2):
            steps = min(WINDOW // 2, lengths[0] - start)
            live = [int((lengths > start + t).sum()) for t in range(steps)]
            block = np.full((steps + 1, live[0]), end)  # the ids before, and those to predict
            block[0] = last[: live[0]]
            for j in range(live[0]):
                part = texts[some[j]][start : start + steps]
                block[1 : len(part) + 1, j] = part
            came = np.take(given, block[:-1].reshape(-1), axis=1).reshape(-1, steps, live[0])
            states = []
            for t, n in enumerate(live):
                h, _ = _advance(h[:, :n], came[:, t, :n], ut)
                states.append(h)
            last = block[-1]
            targets = np.concatenate([block[t + 1, :n] for t, n in enumerate(live)])
            owners = np.concatenate([np.arange(n) for n in live])
            logs = _log_probabilities(w, np.concatenate(states, axis=1), targets)
            sums += np.bincount(owners, weights=logs, minlength=len(some))
        total[some] = sums
    return total
