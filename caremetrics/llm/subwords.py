"""Ids next to the attention model over classes: what an id adds to the state, and which id of a class comes next.

Every id has a vector that is added where it is read. Which id of a class comes next is a
row of choices down a Huffman tree over the ids of the class. The log odds of a choice are
those of the counts after the class of the id before, and the product of the choice's own vector with
the state of the attention model, which has read all ids of the window. All ids of a class
sum to one in every state; with vectors of zero their shares are the counted ones.
"""

from __future__ import annotations

from heapq import heapify, heappop, heapreplace

import numpy as np

from caremetrics.llm.attention import _AHEAD, CLASSES, WIDTH, WINDOW, _raised, slid, unpacked

_SCALE = np.float32(WIDTH**-0.5)


class Tree:
    """The choices that lead to each id of a class, and their log odds after an id of each class."""

    def __init__(self, classes: np.ndarray, counts: np.ndarray):
        size = len(classes)
        above, side = np.full(2 * size, -1), np.zeros(2 * size, np.float32)
        self.ids, left, right = size, [], []
        for members in (np.flatnonzero(classes == c) for c in range(CLASSES)):
            heap = list(zip((counts[members] + 1).tolist(), members.tolist()))
            heapify(heap)
            while len(heap) > 1:
                (a, one), (b, other) = heappop(heap), heap[0]
                node = size + len(left)
                above[[one, other]], side[[one, other]] = node, (1, -1)
                left.append(one)
                right.append(other)
                heapreplace(heap, (a + b, node))
        self.left, self.right = np.array(left, np.int32), np.array(right, np.int32)
        found, at = [], np.arange(size)
        ids = at
        while len(ids):
            going = above[at] >= 0
            ids, at = ids[going], at[going]
            found.append((ids, above[at] - size, side[at]))
            at = above[at]
        of, nodes, signs = (np.concatenate(parts) for parts in zip(*found))
        order = np.argsort(of, kind="stable")
        self.nodes, self.signs = nodes[order].astype(np.uint16), signs[order]
        self.lengths = np.bincount(of, minlength=size)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __len__(self) -> int:
        """How many choices there are."""
        return len(self.left)

    def weigh(self, weights: np.ndarray) -> None:
        """Odds from what each id weighs (rows) after an id of each class (columns)."""
        total = np.concatenate([weights, np.empty((len(self), CLASSES))])
        for node, (one, other) in enumerate(zip(self.left.tolist(), self.right.tolist()), self.ids):
            np.add(total[one], total[other], out=total[node])  # both came before
        self.odds = (np.log(total[self.left]) - np.log(total[self.right])).astype(np.float32)

    def choices(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The choices that lead to these ids, one after another: whose they are, which, and their sides."""
        lengths = self.lengths[ids]
        of = np.repeat(np.arange(len(ids)), lengths)
        at = np.arange(len(of)) + np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)
        return of, self.nodes[at], self.signs[at]

    def leaning(self, of: np.ndarray, nodes: np.ndarray, before: np.ndarray, state: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Log odds of choices in the states they are made in."""
        known = self.odds.reshape(-1).take(nodes.astype(np.int64) * CLASSES + before[of])
        return known + np.einsum("ij,ij->i", vectors.take(nodes, axis=0), state.take(of, axis=0))

    def told(self, ids: np.ndarray, before: np.ndarray, state: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Natural log of each id's share of its class."""
        of, nodes, signs = self.choices(ids)
        taken = -np.logaddexp(0, -signs * self.leaning(of, nodes, before, state, vectors))
        return np.bincount(of, weights=taken, minlength=len(ids))

    def shares(self) -> np.ndarray:
        """Natural log of the counted share of every id (columns) after an id of each class."""
        every, zeros = np.arange(self.ids), np.zeros((self.ids, WIDTH), np.float32)
        none = np.zeros((len(self), WIDTH), np.float32)
        return np.array([self.told(every, np.full(self.ids, c), zeros, none) for c in range(CLASSES)])


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])


def _summed(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of runs of rows. Pairs of floats are added as one complex number, which takes half the additions."""
    return np.add.reduceat(rows.view(np.complex64), begin, axis=0).view(np.float32)


class Rows:
    """Vectors of which a step changes few: Adagrad by row, and how often each was met."""

    def __init__(self, values: np.ndarray, rate: float):
        self.start, self.values, self.rate = values, values.copy(), rate
        self.square, self.met = np.zeros_like(values), np.zeros(len(values), np.int64)

    def change(self, keys: np.ndarray, slopes: np.ndarray) -> None:
        if len(keys):
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            begin = _runs(keys)
            rows, sums = keys[begin], _summed(slopes.take(order, axis=0), begin)
            self.met[rows] += np.diff(begin, append=len(keys))
            square = self.square.take(rows, axis=0)
            square += sums * sums
            self.square[rows] = square
            np.sqrt(square, out=square)
            square += np.float32(1e-8)
            sums *= np.float32(-self.rate)
            sums /= square
            sums += self.values.take(rows, axis=0)
            self.values[rows] = sums


class Learner:
    """Vectors of ids and choices of one replica, learned beside the weights of the attention model."""

    def __init__(self, tree: Tree, inputs: np.ndarray, choices: np.ndarray, rate: float):
        self.tree, self.inputs, self.choices = tree, Rows(inputs, rate), Rows(choices, rate)

    def at(self, seen: np.ndarray, aim: np.ndarray, before: np.ndarray, counted: np.ndarray) -> Learner:
        """Go to these places: ids read, ids to come where they are counted, and the classes read."""
        self.seen, self.before = seen.reshape(-1).astype(np.uint16), before.reshape(-1)
        self.chosen = np.flatnonzero(counted)
        self.aim = aim.reshape(-1)[self.chosen]
        self.choosing = self.tree.lengths[self.aim] > 0  # the others are alone in their class
        return self

    def read(self, x: np.ndarray) -> None:
        x += self.inputs.values.take(self.seen, axis=0)

    def slope(self, state: np.ndarray, share: float) -> np.ndarray:
        """Learn the choices of the places, and give the slope of their loss by state."""
        out = np.zeros((len(state), WIDTH), np.float32)
        places = self.chosen[self.choosing]
        if not len(places):
            return out
        of, nodes, signs = self.tree.choices(self.aim[self.choosing])
        vectors, held = self.choices.values.take(nodes, axis=0), state.take(places, axis=0).take(of, axis=0)
        leaning = self.tree.odds.reshape(-1).take(nodes.astype(np.int64) * CLASSES + self.before[places][of])
        leaning += np.einsum("ij,ij->i", vectors, held)
        leaning *= signs
        wrong = np.exp(np.minimum(leaning, 60, out=leaning), out=leaning)
        wrong += 1
        np.divide(signs, wrong, out=wrong)
        wrong *= np.float32(-share)
        held *= wrong[:, None]
        vectors *= wrong[:, None]
        out[places] = _summed(vectors, _runs(of))
        self.choices.change(nodes, held)
        return out

    def was_read(self, slope: np.ndarray) -> None:
        whole = len(self.chosen) == len(self.seen)  # else the rest is filling
        self.inputs.change(*((self.seen, slope) if whole else (self.seen[self.chosen], slope[self.chosen])))


class IdScorer:
    """Natural log probabilities of the next id."""

    def __init__(self, weights: np.ndarray, classes: np.ndarray, tree: Tree, inputs: np.ndarray, choices: np.ndarray):
        w = unpacked(weights.astype(np.float32))
        self.each, self.places = w["E"][classes] + inputs, w["P"]
        self.met, self.through, self.out, self.bias = w["Q"] @ w["K"].T * _SCALE, w["V"] @ w["O"], w["U"], w["b"]
        self.classes, self.tree, self.choices = classes, tree, choices

    def windows(self, seen: np.ndarray, aim: np.ndarray, skip: int = 0) -> np.ndarray:
        """Of the places of each window from ``skip``; ``aim`` has only those."""
        x = self.each.take(seen, axis=0) + self.places
        a = _raised((x[:, skip:] @ self.met) @ x.transpose(0, 2, 1) + _AHEAD[skip:], _AHEAD[skip:])
        z = a @ x
        z /= (a.reshape(-1, WINDOW) @ np.ones(WINDOW, np.float32)).reshape(len(a), -1, 1)
        h = (z @ self.through + x[:, skip:]).reshape(-1, WIDTH)
        logits = h @ self.out
        logits += self.bias
        aim, before = aim.reshape(-1), self.classes[seen[:, skip:].reshape(-1)]
        chosen = logits.reshape(-1)[np.arange(len(logits)) * CLASSES + self.classes[aim]]
        top = logits.max(axis=-1)
        logits -= top[:, None]
        told = chosen - top - np.log(np.exp(logits, out=logits) @ np.ones(CLASSES, np.float32))
        return (told + self.tree.told(aim, before, h, self.choices)).reshape(len(seen), -1)

    def stream(self, ids: np.ndarray, first: int, bounds: np.ndarray) -> np.ndarray:
        """Log probability of every id of a stream of documents (``bounds``), each scored once."""
        seen = np.concatenate([[first], ids[:-1]]).astype(np.int64)
        return slid(len(ids), bounds, lambda index, aim, skip: self.windows(seen[index], ids[aim], skip))
