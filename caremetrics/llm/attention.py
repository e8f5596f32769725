"""A small causal self-attention model over token classes, in numpy.

One attention layer reads a window of classes and predicts the class that comes
next at every place. Used inside tasks, both to train replicas and to score. What single
ids add to the classes is in ``subwords``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# Classes, width, window length, and how far windows advance.
CLASSES, WIDTH, WINDOW, STRIDE = 32, 16, 16, 12
_SCALE = np.float32(WIDTH**-0.5)
_AHEAD = np.triu(np.full((WINDOW, WINDOW), -1e9, dtype=np.float32), 1)
_SHAPES = {
    "E": (CLASSES, WIDTH), "P": (WINDOW, WIDTH), "Q": (WIDTH, WIDTH), "K": (WIDTH, WIDTH),
    "V": (WIDTH, WIDTH), "O": (WIDTH, WIDTH), "U": (WIDTH, CLASSES), "b": (CLASSES,),
}
_ENDS = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()]).tolist()
# Windows scored at once, so that their arrays stay in the cache.
_AT_ONCE = 512


def initial(frequency: np.ndarray) -> np.ndarray:
    """Weights that predict the given class frequencies whatever the context."""
    rng = np.random.default_rng(7)
    parts = {n: rng.normal(0, 0.3, s) if n in "EP" else rng.normal(0, WIDTH**-0.5, s) for n, s in _SHAPES.items()}
    parts["U"] *= 0.1
    parts["b"] = np.log((frequency + 1) / (frequency.sum() + CLASSES))
    return np.concatenate([parts[n].reshape(-1) for n in _SHAPES]).astype(np.float32)


def unpacked(weights: np.ndarray) -> dict[str, np.ndarray]:
    places = zip(_SHAPES.items(), [0, *_ENDS], _ENDS)
    return {name: weights[at:end].reshape(shape) for (name, shape), at, end in places}


def _highest(x: np.ndarray) -> np.ndarray:
    """Maximum over the last axis, which is kept; halves are compared whole, as short rows one by one are slow."""
    while x.shape[-1] > 1 and x.shape[-1] % 2 == 0:
        half = x.shape[-1] // 2
        x = np.maximum(x[..., :half], x[..., half:])
    return x.max(axis=-1, keepdims=True) if x.shape[-1] > 1 else x


def _raised(x: np.ndarray, hidden: np.ndarray | None = None) -> np.ndarray:
    """Exponents in place, of each row less its maximum if some could leave the range of floats."""
    if not (x.max() < 60 and x.min() > -60):
        if hidden is not None:
            x += hidden
        x -= _highest(x)
    return np.exp(x, out=x)


class Gradient:
    """Gradient of the mean cross entropy over counted places, for a fixed number of windows.

    All arrays are made once. Queries and keys meet as one product of their weights, and
    so do values and outputs; row sums are made by products, as short rows one by one are slow.
    """

    def __init__(self, windows: int, dtype: np.dtype):
        places = windows * WINDOW
        self.windows, self.first = windows, np.arange(places) * CLASSES
        self.x, self.y, self.z, self.sums, self.dh, self.dz, self.spare = np.empty((7, places, WIDTH), dtype)
        self.turned, self.weighed, self.ds = np.empty((3, windows, WINDOW, WINDOW), dtype)
        self.h = np.ones((places, WIDTH + 1), dtype)  # a last column for the bias
        self.dl, self.marks = np.empty((2, places, CLASSES), dtype)
        self.each_class = np.eye(CLASSES, dtype=dtype)
        self.looks = np.tile(np.tri(WINDOW, dtype=dtype), (windows, 1, 1))
        self.ones, self.class_ones, self.window_ones = (np.ones(n, dtype) for n in ((WINDOW, WIDTH), CLASSES, windows))
        self.out = np.empty(_ENDS[-1], dtype)
        self.parts = unpacked(self.out)
        self.weights, self.views = None, {}

    def __call__(self, weights: np.ndarray, seen: np.ndarray, aim: np.ndarray, counted: np.ndarray, words=None) -> np.ndarray:
        """Of classes; ``words`` (a ``subwords.Learner``) learns the ids at these places with them."""
        if weights is not self.weights:  # a replica's change in place
            self.weights, self.views = weights, unpacked(weights)
        w, g, shape = self.views, self.parts, (self.windows, WINDOW, WIDTH)
        x, y, z, sums, dh, dz, spare = self.x, self.y, self.z, self.sums, self.dh, self.dz, self.spare
        turned, a, ds, h, dl = self.turned, self.weighed, self.ds, self.h, self.dl
        seen, aim = seen.reshape(-1), aim.reshape(-1)
        met, through, last = w["Q"] @ w["K"].T * _SCALE, w["V"] @ w["O"], weights[_ENDS[-3] :].reshape(WIDTH + 1, CLASSES)
        # Forward.
        w["E"].take(seen, axis=0, out=x, mode="clip")
        if words is not None:
            words.read(x)
        each = x.reshape(self.windows, -1)
        each += w["P"].reshape(-1)
        np.matmul(x, met, out=y)
        np.copyto(turned, x.reshape(shape).transpose(0, 2, 1))
        _raised(np.matmul(y.reshape(shape), turned, out=a), _AHEAD)
        a *= self.looks
        np.matmul(a.reshape(-1, WINDOW), self.ones, out=sums)
        np.matmul(a, x.reshape(shape), out=z.reshape(shape))
        z /= sums
        np.add(np.matmul(z, through, out=spare), x, out=h[:, :WIDTH])
        _raised(np.matmul(h, last, out=dl))
        # Backward.
        share = 1 / max(int(np.count_nonzero(counted)), 1)
        dl *= (share / (dl @ self.class_ones)).reshape(-1, 1)
        dl.reshape(-1)[self.first + aim] -= share
        if share * len(seen) > 1:
            dl *= counted.reshape(-1, 1)
        np.matmul(h.T, dl, out=self.out[_ENDS[-3] :].reshape(WIDTH + 1, CLASSES))
        np.matmul(dl, w["U"].T.copy(), out=dh)
        if words is not None:
            dh += words.slope(h[:, :WIDTH], share)
        dthrough = z.T @ dh
        np.matmul(dthrough, w["O"].T, out=g["V"])
        np.matmul(w["V"].T, dthrough, out=g["O"])
        np.matmul(dh, through.T.copy(), out=dz)
        dz /= sums
        np.matmul(dz.reshape(shape), turned, out=ds)
        z *= dz
        ds -= np.matmul(z, self.ones, out=spare).reshape(ds.shape)
        ds *= a
        np.matmul(ds, x.reshape(shape), out=z.reshape(shape))
        dmet = x.T @ z * _SCALE
        np.matmul(dmet, w["K"], out=g["Q"])
        np.matmul(dmet.T, w["Q"], out=g["K"])
        dx = dh
        dx += np.matmul(z, met.T.copy(), out=spare)
        dx += np.matmul(a.transpose(0, 2, 1), dz.reshape(shape), out=spare.reshape(shape)).reshape(dx.shape)
        dx += np.matmul(ds.transpose(0, 2, 1), y.reshape(shape), out=spare.reshape(shape)).reshape(dx.shape)
        np.matmul(self.each_class.take(seen, axis=0, out=self.marks, mode="clip").T, dx, out=g["E"])
        np.matmul(self.window_ones, dx.reshape(self.windows, -1), out=g["P"].reshape(-1))
        if words is not None:
            words.was_read(dx)
        return self.out


def gradient(weights: np.ndarray, seen: np.ndarray, aim: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """Gradient of the mean cross entropy over counted places; arrays are (windows, places)."""
    return Gradient(len(seen), weights.dtype)(weights, seen, aim, counted)


class Trainer:
    """Adam over one replica."""

    def __init__(self, weights: np.ndarray, rate: float):
        self.weights, self.rate = weights.copy(), rate
        self.mean, self.square, self.steps = np.zeros_like(weights), np.zeros_like(weights), 0
        self.gradient = None

    def step(self, seen: np.ndarray, aim: np.ndarray, counted: np.ndarray, words=None) -> None:
        if self.gradient is None or self.gradient.windows != len(seen):
            self.gradient = Gradient(len(seen), self.weights.dtype)
        g = self.gradient(self.weights, seen, aim, counted, words)
        self.steps += 1
        # The sums are ten and a hundred times the means, which lack some at the start: all in one factor.
        first, second = 1 - 0.9**self.steps, (1 - 0.99**self.steps) ** 0.5
        self.mean *= 0.9
        self.mean += g
        self.square *= 0.99
        g *= g
        self.square += g
        change = np.sqrt(self.square, out=g)
        change += 1e-5 * second
        np.divide(self.mean, change, out=change)
        change *= self.rate * second / first
        self.weights -= change


class Scorer:
    """Natural log probabilities of the next class, with products of weights made once.

    A class at a place is one of few inputs, so what each gives to another is looked up.
    """

    def __init__(self, weights: np.ndarray):
        w = unpacked(weights.astype(np.float32))
        each = (w["E"][:, None] + w["P"]).reshape(-1, WIDTH)
        through = w["O"] @ w["U"]
        self.queries, self.keys = each @ w["Q"] * _SCALE, each @ w["K"]
        self.direct, self.values = each @ w["U"] + w["b"], each @ w["V"] @ through
        # Exponents stay far below overflow unless weights are very large.
        longest = [np.sqrt((x**2).sum(-1)).max() for x in (self.queries, self.keys, self.values)]
        self.safe = longest[0] * longest[1] < 60 and np.abs(self.direct).max() + longest[2] < 60
        if self.safe:
            place = np.arange(len(each)) % WINDOW
            self.weighed = np.exp(self.queries @ self.keys.T) * (place[:, None] >= place)

    def _weighed(self, at: np.ndarray, skip: int) -> np.ndarray:
        """Weights of all places of a window, not yet divided by their sum, for its places from ``skip``."""
        if self.safe:
            return self.weighed.reshape(-1).take(at[:, skip:, None] * len(self.keys) + at[:, None, :], mode="clip")
        attention = self.queries[at[:, skip:]] @ self.keys[at].transpose(0, 2, 1) + _AHEAD[skip:]
        attention -= attention.max(axis=-1, keepdims=True)
        return np.exp(attention, out=attention)

    def windows(self, seen: np.ndarray, aim: np.ndarray, skip: int = 0) -> np.ndarray:
        """Of the places of each window from ``skip``; ``aim`` has only those."""
        at = seen * WINDOW + np.arange(WINDOW)
        weighed = self._weighed(at, skip)
        scores = (weighed @ self.values.take(at, axis=0, mode="clip")).reshape(-1, CLASSES)
        scores /= (weighed.reshape(-1, WINDOW) @ np.ones(WINDOW, np.float32))[:, None]
        scores += self.direct.take(at[:, skip:].reshape(-1), axis=0, mode="clip")
        chosen = scores.reshape(-1)[np.arange(len(scores)) * CLASSES + aim.reshape(-1)]
        if not self.safe:
            top = scores.max(axis=-1)
            scores -= top[:, None]
            chosen = chosen - top
        np.exp(scores, out=scores)
        return (chosen - np.log(scores @ np.ones(CLASSES, np.float32))).reshape(len(seen), -1)

    def stream(self, classes: np.ndarray, first: int, bounds: np.ndarray) -> np.ndarray:
        """Log probability of every class of a stream of documents (``bounds``), each scored once.

        What precedes a document is the class ``first``.
        """
        seen = np.concatenate([[first], classes[:-1]]).astype(np.int64)
        return slid(len(classes), bounds, lambda index, aim, skip: self.windows(seen[index], classes[aim], skip))


def slid(size: int, bounds: np.ndarray, judged: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> np.ndarray:
    """What ``judged`` says of every place of a stream of documents (``bounds``), each place once.

    Windows of a document overlap; the first counts in full, later ones from
    where the one before ended.
    """
    out = np.zeros(size, dtype=np.float32)
    sizes = np.diff(bounds)
    counts = np.where(sizes > 0, 1 + -(-np.maximum(sizes - WINDOW, 0) // STRIDE), 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin, end = bounds[:-1][owner] + turn * STRIDE, bounds[1:][owner]
    for later, skip in ((False, 0), (True, WINDOW - STRIDE)):
        chosen = np.flatnonzero((turn > 0) == later)
        for at in range(0, len(chosen), _AT_ONCE):
            some = chosen[at : at + _AT_ONCE]
            index = begin[some, None] + np.arange(WINDOW)
            counted = index[:, skip:] < end[some, None]
            index = np.minimum(index, size - 1)
            aim = index[:, skip:]
            out[aim[counted]] = judged(index, aim, skip)[counted]
    return out
