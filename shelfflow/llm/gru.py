"""A small gated recurrent network over symbols, with a class-factored softmax, in numpy.

Symbol 0 ends a document. The input of a step is the symbol before, and after a 0 the state starts from nothing, so
documents can follow one another in a lane. A symbol's probability is that of its class times its own within the class; symbols
are dealt to classes in turn, so frequent ones spread over all of them.

Many lanes run side by side, the longest first. Lanes are read in windows: the state is carried from window to window, while
gradients stop at the window's beginning (truncated backpropagation).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WINDOW = 32


@dataclass(frozen=True)
class Shape:
    symbols: int
    hidden: int = 16
    classes: int = 32

    @property
    def per_class(self) -> int:
        return -(-self.symbols // self.classes)

    def blocks(self) -> list[tuple[int, ...]]:
        h, c, m = self.hidden, self.classes, self.per_class
        return [(self.symbols, 3 * h), (h, 3 * h), (h, c), (c,), (c, h, m), (c, m)]

    @property
    def size(self) -> int:
        return sum(int(np.prod(b)) for b in self.blocks())

    def split(self, flat: np.ndarray) -> list[np.ndarray]:
        """Views of the parameter blocks: input table, recurrence, class weights and bias, word weights and biases."""
        views, at = [], 0
        for block in self.blocks():
            n = int(np.prod(block))
            views.append(flat[at : at + n].reshape(block))
            at += n
        return views

    def start(self, counts: np.ndarray, seed: int = 1) -> np.ndarray:
        """Small random weights; the biases say what the symbols' counts say."""
        rng = np.random.default_rng(seed)
        flat = (rng.standard_normal(self.size) * 0.1).astype(np.float32)
        _, recurrence, _, class_bias, _, word_bias = self.split(flat)
        recurrence[:] = rng.standard_normal(recurrence.shape) / np.sqrt(self.hidden)
        padded = np.full(self.classes * self.per_class, 1e-3)
        padded[: self.symbols] = counts + 0.5
        table = padded.reshape(self.per_class, self.classes).T
        class_bias[:] = np.log(table.sum(axis=1) / table.sum())
        word_bias[:] = np.log(table / table.sum(axis=1, keepdims=True))
        return flat


class Lanes:
    """Documents dealt to lanes of about equal length; each document ends with a 0."""

    def __init__(self, documents: list[np.ndarray], lanes: int):
        order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
        heap = [(0, lane) for lane in range(max(1, min(lanes, len(documents))))]
        held: list[list[int]] = [[] for _ in heap]
        for i in order:
            load, lane = heapq.heappop(heap)
            held[lane].append(i)
            heapq.heappush(heap, (load + len(documents[i]) + 1, lane))
        loads = [sum(len(documents[i]) + 1 for i in docs) for docs in held]
        by_load = sorted(range(len(held)), key=lambda lane: -loads[lane])
        self.order = [i for lane in by_load for i in held[lane]]
        end = np.zeros(1, np.uint16)
        parts = [x for i in self.order for x in (documents[i], end)]
        self.symbols = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
        self.lengths = np.array([loads[lane] for lane in by_load if loads[lane]], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        sizes = np.array([len(documents[i]) + 1 for i in self.order], np.int64)
        self.firsts = np.cumsum(sizes) - sizes

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Inputs by step and lane, whether a step is in its lane, and its place in ``symbols``."""
        for begin in range(0, int(self.lengths[0]) if len(self.lengths) else 0, WINDOW):
            active = int(np.searchsorted(-self.lengths, -begin, "left"))
            steps = np.arange(begin, begin + WINDOW)[:, None]
            live = steps < self.lengths[None, :active]
            place = np.minimum(self.starts[None, :active] + steps, len(self.symbols) - 1)
            inputs = np.where(live & (steps > 0), self.symbols[place - (place > 0)], 0)
            last = int(live.any(axis=1).sum())
            yield inputs[:last], live[:last], place[:last]


class Network:
    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat
        self.table, self.recurrence, self.class_w, self.class_b, self.word_w, self.word_b = shape.split(flat)

    def run(self, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """States after each step, from the state before the first, and what backpropagation needs."""
        h = self.shape.hidden
        steps, lanes = inputs.shape
        states, before = np.empty((steps, lanes, h), np.float32), np.empty((steps, lanes, h), np.float32)
        gates, new = np.empty((steps, lanes, 2 * h), np.float32), np.empty((steps, lanes, h), np.float32)
        moved = np.empty((steps, lanes, 3 * h), np.float32)
        rows = self.table[inputs]
        begins = [np.flatnonzero(row == 0) for row in inputs]
        for t in range(steps):
            np.copyto(before[t], state)
            if len(begins[t]):
                before[t][begins[t]] = 0
            np.matmul(before[t], self.recurrence, out=moved[t])
            gate = gates[t]
            np.add(rows[t, :, : 2 * h], moved[t, :, : 2 * h], out=gate)
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.multiply(gate[:, h:], moved[t, :, 2 * h :], out=new[t])
            new[t] += rows[t, :, 2 * h :]
            np.tanh(new[t], out=new[t])
            state = states[t]
            np.subtract(before[t], new[t], out=state)
            state *= gate[:, :h]
            state += new[t]
        return states, (before, gates, new, moved)

    def _groups(self, targets: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The rows of each class that occurs."""
        group = (targets % self.shape.classes).astype(np.uint16)
        order = np.argsort(group, kind="stable")
        cut = np.searchsorted(group[order], np.arange(self.shape.classes + 1))
        return [(c, order[cut[c] : cut[c + 1]]) for c in range(self.shape.classes) if cut[c] < cut[c + 1]]

    def log_probability(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithms of the targets' probabilities, a row per state."""
        within = targets // self.shape.classes
        logits = states @ self.class_w + self.class_b
        out = logits[np.arange(len(targets)), targets % self.shape.classes]
        out -= np.log(_exp_sums(logits))
        for c, own in self._groups(targets):
            logits = states[own] @ self.word_w[c] + self.word_b[c]
            picked = logits[np.arange(len(own)), within[own]]
            out[own] += picked - np.log(_exp_sums(logits))
        return out

    def _wrong(self, logits: np.ndarray, gold: np.ndarray, n: int) -> np.ndarray:
        """What each logit contributes to the mean negative log probability; overwrites the logits."""
        totals = _exp_sums(logits)
        logits *= (1 / (n * totals))[:, None]
        logits[np.arange(len(gold)), gold] -= 1 / n
        return logits

    def gradient(self, inputs, live, targets, states, tape) -> np.ndarray:
        """The mean gradient of the negative log probability over one window."""
        h, n = self.shape.hidden, max(1, len(targets))
        before, gates, new, moved = tape
        out = np.zeros_like(self.flat)
        table, recurrence, class_w, class_b, word_w, word_b = self.shape.split(out)
        seen = states[live]
        wrong = self._wrong(seen @ self.class_w + self.class_b, targets % self.shape.classes, n)
        class_w += seen.T @ wrong
        class_b += wrong.sum(axis=0)
        back = wrong @ self.class_w.T
        within = targets // self.shape.classes
        for c, own in self._groups(targets):
            rows = seen[own]
            wrong = self._wrong(rows @ self.word_w[c] + self.word_b[c], within[own], n)
            word_w[c] = rows.T @ wrong
            word_b[c] = wrong.sum(axis=0)
            back[own] += wrong @ self.word_w[c].T
        slope = np.zeros_like(states)
        slope[live] = back
        update, reset = gates[:, :, :h], gates[:, :, h:]
        to_new = (1 - update) * (1 - new * new)
        to_update = (before - new) * update * (1 - update)
        to_reset = moved[:, :, 2 * h :] * reset * (1 - reset)
        into = np.empty((*inputs.shape, 3 * h), np.float32)
        through = np.empty_like(into)
        carried = np.zeros_like(states[0])
        begins = [np.flatnonzero(row == 0) for row in inputs]
        turned = np.ascontiguousarray(self.recurrence.T)
        for t in range(len(inputs) - 1, -1, -1):
            carried += slope[t]
            row, passed = into[t], through[t]
            d_new = row[:, 2 * h :]
            np.multiply(carried, to_new[t], out=d_new)
            np.multiply(carried, to_update[t], out=row[:, :h])
            np.multiply(d_new, to_reset[t], out=row[:, h : 2 * h])
            passed[:, : 2 * h] = row[:, : 2 * h]
            np.multiply(d_new, reset[t], out=passed[:, 2 * h :])
            carried *= update[t]
            carried += passed @ turned
            if len(begins[t]):
                carried[begins[t]] = 0
        recurrence += before.reshape(-1, h).T @ through.reshape(-1, 3 * h)
        used = inputs.ravel().astype(np.uint16)
        order = np.argsort(used, kind="stable")
        cut = np.flatnonzero(np.append(True, np.diff(used[order]) > 0))
        table[used[order][cut]] = np.add.reduceat(into.reshape(-1, 3 * h)[order], cut, axis=0)
        return out


def _exp_sums(logits: np.ndarray) -> np.ndarray:
    """Row sums of the exponentials, which take the place of the logits from here on (far below overflow)."""
    np.minimum(logits, 60, out=logits)
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], logits.dtype)


def score(shape: Shape, flat: np.ndarray, documents: list[np.ndarray], lanes: int = 256) -> np.ndarray:
    """The natural log probability of each whole document, its end included."""
    dealt, network = Lanes(documents, lanes), Network(shape, flat)
    found = np.zeros(len(dealt.symbols))
    state = np.zeros((len(dealt.lengths), shape.hidden), np.float32)
    for inputs, live, place in dealt.windows():
        states, _ = network.run(inputs, state[: inputs.shape[1]])
        at = place[live]
        found[at] = network.log_probability(states[live], dealt.symbols[at])
        state = states[-1]
    out = np.zeros(len(documents))
    if len(documents):
        out[dealt.order] = np.add.reduceat(found, dealt.firsts)
    return out


class Trainer:
    """Adam over the windows of one batch of documents after another."""

    def __init__(self, shape: Shape, flat: np.ndarray, rate: float):
        self.shape, self.flat, self.rate = shape, flat.copy(), rate
        self.moment, self.square = np.zeros_like(flat), np.zeros_like(flat)
        self.step = 0

    def learn(self, documents: list[np.ndarray], lanes: int) -> int:
        """One pass; returns the number of symbols read."""
        dealt = Lanes(documents, lanes)
        state = np.zeros((len(dealt.lengths), self.shape.hidden), np.float32)
        for inputs, live, place in dealt.windows():
            network = Network(self.shape, self.flat)
            states, tape = network.run(inputs, state[: inputs.shape[1]])
            slope = network.gradient(inputs, live, dealt.symbols[place[live]], states, tape)
            state = states[-1]
            self._move(slope, float(live.sum()) / (WINDOW * lanes))
        return len(dealt.symbols)

    def _move(self, slope: np.ndarray, share: float) -> None:
        """A step whose length follows the share of a full window's symbols that it has seen."""
        self.step += 1
        self.moment += 0.1 * (slope - self.moment)
        self.square += 0.01 * (slope * slope - self.square)
        rate = self.rate * min(1.0, share) * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        self.flat -= (rate * self.moment / (np.sqrt(self.square) + 1e-6)).astype(np.float32)
