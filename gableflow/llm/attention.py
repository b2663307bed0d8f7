"""A causal self-attention model over subword ids, trained and applied in numpy.

Every subword has an embedding. One head attends over windows of WINDOW tokens, with a learned bias for every distance;
what it gathers and the last token's own embedding give the next subword by an adaptive softmax: the commonest subwords are
outputs of their own, the others stand behind classes. Within its class a subword has its share after the kind of
subword that stands before it, from counts over the whole corpus, so all probabilities add up to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Subwords that are outputs of their own, classes of the others, kinds of the subword before (and one for the start).
HEAD, CLASSES, KINDS = 64, 64, 16
OUTPUTS = HEAD + CLASSES
#: Width, window, tokens of context that a later window repeats when it scores.
WIDTH, WINDOW, OVERLAP = 16, 32, 16
STRIDE = WINDOW - OVERLAP
#: Windows of a step, windows among which a trainer shuffles, steps at least, step sizes of matrices and of embeddings.
BATCH, POOL, LEAST_STEPS, RATE, RATE_IN = 128, 8192, 60, 0.01, 0.05
#: Windows, and blocks of STRIDE tokens when scoring, that go through at a time.
CHUNK, BLOCKS = 32, 64
#: What unseen subwords of a class count, and how many times a class's own shares count beside those after a kind.
SMOOTH, BACK = 0.1, 8.0
#: Buckets of the id before, by which subwords are first told apart.
BUCKETS = 16


def shapes(vocabulary: int) -> dict[str, tuple[int, ...]]:
    d = WIDTH
    return {"q": (d, d), "k": (d, d), "v": (d, d), "far": (WINDOW,), "out": (2 * d, OUTPUTS), "bias": (OUTPUTS,), "e": (vocabulary + 1, d)}


def unflat(flat: np.ndarray, vocabulary: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(vocabulary).items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def start_weights(vocabulary: int, bias: np.ndarray | None = None, seed: int = 7) -> np.ndarray:
    """Random weights; bias: the outputs' log shares."""
    rng = np.random.default_rng(seed)
    parts = {name: np.zeros(s) if name in ("far", "bias") else rng.normal(0, 0.3 if name == "e" else 0.5 * s[0] ** -0.5, s) for name, s in shapes(vocabulary).items()}
    if bias is not None:
        parts["bias"] = bias
    return np.concatenate([np.ravel(p) for p in parts.values()]).astype(np.float32)


def clusters(counts: np.ndarray, n: int) -> np.ndarray:
    """counts (subwords, buckets) after each bucket -> one of n classes for each: k-means on the square roots of the shares.

    It starts from the commonest subwords and weighs by the square roots of their counts; subwords never seen are spread.
    """
    total = counts.sum(axis=1)
    seen = np.flatnonzero(total > 0)
    kind = np.arange(len(counts)) % n
    if len(seen):
        order = seen[np.lexsort((seen, -total[seen]))]
        base = counts.sum(axis=0) + 1.0
        x = np.sqrt((counts[order] + base / base.sum() * 4) / (total[order] + 4)[:, None])
        weight = np.sqrt(total[order])
        centre = x[:n].copy() if len(x) >= n else np.vstack([x, np.ones((n - len(x), x.shape[1]))])
        for _ in range(8):
            near = np.argmax(x @ centre.T - 0.5 * (centre * centre).sum(axis=1), axis=1)
            mass = np.bincount(near, weight, n)
            sums = np.stack([np.bincount(near, weight * x[:, j], n) for j in range(x.shape[1])], axis=1)
            centre = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centre)
        kind[order] = near
    return kind


class Outputs:
    """Which output each subword stands behind, and its share there after each kind of subword before it."""

    def __init__(self, counts: np.ndarray):
        """counts (subwords, BUCKETS): how often each stands after each bucket of ids."""
        total = counts.sum(axis=1)
        common = np.lexsort((np.arange(len(total)), -total))[:HEAD]
        self.kind = np.r_[clusters(counts, KINDS), KINDS].astype(np.int64)  # the last stands for the start
        rest = np.setdiff1d(np.arange(len(total)), common)
        self.of = np.empty(len(total), np.int64)
        self.of[common] = np.arange(len(common))
        self.of[rest] = HEAD + clusters(counts[rest], CLASSES)
        self.own = np.zeros(len(total), bool)
        self.own[common] = True
        share = np.bincount(self.of, total + SMOOTH, OUTPUTS)
        self.bias = np.log(np.maximum(share, SMOOTH) / np.maximum(share, SMOOTH).sum())

    def add_shares(self, after: np.ndarray) -> None:
        """after (subwords, KINDS + 1): how often each stands after each kind."""
        total = after.sum(axis=1) + SMOOTH
        plain = total / np.bincount(self.of, total, OUTPUTS)[self.of]
        sums = np.stack([np.bincount(self.of, after[:, k], OUTPUTS) for k in range(after.shape[1])], axis=1)
        share = (after + BACK * plain[:, None]) / (sums[self.of] + BACK)
        share[self.own] = 1.0
        self.within = np.log10(share).astype(np.float32)


#: Logits are made in base 2, by a factor in the narrow matrices before them: numpy's exp2 is faster than its exp.
LOG2E, LN2 = float(np.log2(np.e)), float(np.log(2))


def _exp2(x: np.ndarray) -> np.ndarray:
    """exp2 in place, up to a factor for each row: rows are shifted by their largest only if any would overflow."""
    if x.max(initial=0.0) > 115:
        x -= x.max(axis=-1, keepdims=True)
    return np.exp2(x, out=x)


def _thirds(wide: np.ndarray) -> tuple[np.ndarray, ...]:
    """Views of three matrices that lie side by side."""
    return tuple(wide[..., i * WIDTH : (i + 1) * WIDTH] for i in range(3))


class Room:
    """Arrays that the steps of a trainer use again and again: for CHUNK windows they stay in a core's cache, and no step asks for memory.

    Products are taken window by window, as many small ones: for so narrow matrices they are faster than a long one.
    """

    def __init__(self, kind: np.dtype):
        d = WIDTH
        of = lambda n: np.empty((CHUNK, WINDOW, n), kind)
        self.qkv, self.d_qkv, self.both, self.scaled, self.out, self.d_both = of(3 * d), of(3 * d), of(2 * d + 1), of(2 * d + 1), of(OUTPUTS), of(2 * d)
        self.a, self.d_a, self.d_z, self.dots = of(WINDOW), of(WINDOW), of(d), of(d)
        self.both[:, :, -1] = 1
        self.place = (np.arange(CHUNK * WINDOW) * OUTPUTS).reshape(CHUNK, WINDOW)
        self.ones = np.ones(max(WINDOW, OUTPUTS, CHUNK), kind)


def _sums_by_id(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, and the sums of their rows of values."""
    order = np.argsort(ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids, kind="stable")  # 16-bit numbers are sorted by their digits
    ids = ids[order]
    new = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return ids[new], np.add.reduceat(values.take(order, axis=0), new, axis=0)


def step(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, room: Room | None = None) -> tuple[float, dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Mean negative log likelihood of outputs y >= 0 after inputs x, both (batch, WINDOW), the gradients of the matrices, and the
    rows of embeddings that x uses with theirs.

    Windows go through in chunks whose gradients are added up. Exponentials stay as they are: the narrow factors beside them
    are divided by the sums instead.
    """
    d, kind = WIDTH, p["q"].dtype.type
    room, x = room or Room(p["q"].dtype), x.astype(np.intp)
    wide = np.concatenate([p["q"] * kind(LOG2E * d**-0.5), p["k"], p["v"]], axis=1)
    gap = np.arange(WINDOW)[:, None] - np.arange(WINDOW)
    far = np.where(gap >= 0, p["far"][np.abs(gap)] * kind(LOG2E), kind(-1e9))
    outward, inward = np.concatenate([p["out"], p["bias"][None]]) * kind(LOG2E), np.ascontiguousarray(p["out"].T)
    wide_in = np.concatenate([p["q"] * kind(d**-0.5), p["k"] * kind(LN2), p["v"]], axis=1).T.copy()  # keys meet queries in base 2
    n = max(1, int((y >= 0).sum()))
    loss, g_out, g_wide, g_far = 0.0, kind(0), kind(0), kind(0)
    d_e = np.empty((*x.shape, d), kind)
    for at in range(0, len(x), CHUNK):
        target = y[at : at + CHUNK]
        w = len(target)
        qkv, d_qkv, both, scaled, out, d_both, a, d_a, d_z, dots = (r[:w] for r in (room.qkv, room.d_qkv, room.both, room.scaled, room.out, room.d_both, room.a, room.d_a, room.d_z, room.dots))
        z, e = both[:, :, :d], both[:, :, d : 2 * d]
        e[:] = p["e"].take(x[at : at + CHUNK], axis=0)
        q, k, v = _thirds(np.matmul(e, wide, out=qkv))
        np.matmul(q, k.transpose(0, 2, 1), out=a)
        a += far
        _exp2(a)
        per = 1 / (a @ room.ones[:WINDOW])[:, :, None]
        np.multiply(a @ v, per, out=z)
        _exp2(np.matmul(both, outward, out=out))
        total = out @ room.ones[:OUTPUTS]
        real = target >= 0
        place = room.place[:w] + np.maximum(target, 0)
        said = out.reshape(-1)[place]
        loss -= np.log(said[real] / total[real] + 1e-30).sum() / n
        out.reshape(-1)[place] = said - total
        scale = (real / (total * kind(n)))[:, :, None]
        np.multiply(both, scale, out=scaled)
        g_out = g_out + (scaled.transpose(0, 2, 1) @ out).sum(axis=0)
        np.matmul(out, inward, out=d_both)
        d_both *= scale
        np.multiply(d_both[:, :, :d], per, out=d_z)
        np.matmul(d_z, v.transpose(0, 2, 1), out=d_a)
        d_a -= (np.multiply(d_z, z, out=dots) @ room.ones[:d])[:, :, None]
        d_a *= a
        g_far = g_far + room.ones[:w] @ d_a.reshape(w, -1)
        d_q, d_k, d_v = _thirds(d_qkv)
        np.matmul(d_a, k, out=d_q)
        np.matmul(d_a.transpose(0, 2, 1), q, out=d_k)
        np.matmul(a.transpose(0, 2, 1), d_z, out=d_v)
        g_wide = g_wide + (e.transpose(0, 2, 1) @ d_qkv).sum(axis=0)
        own = d_e[at : at + CHUNK]
        np.matmul(d_qkv, wide_in, out=own)
        own += d_both[:, :, d:]
    g = {"out": g_out[: 2 * d], "bias": g_out[2 * d], "q": g_wide[:, :d] * kind(d**-0.5), "k": g_wide[:, d : 2 * d] * kind(LN2), "v": g_wide[:, 2 * d :]}
    g["far"] = np.bincount(np.abs(gap)[gap >= 0], g_far.reshape(WINDOW, WINDOW)[gap >= 0], WINDOW).astype(kind)
    return float(loss), g, *_sums_by_id(x.ravel(), d_e.reshape(-1, d))


class Trainer:
    """Weights moved by Adam (matrices) and by Adagrad (rows of embeddings) over windows that come in any portions.

    The result depends on the order of the texts, not on how they are cut into portions.
    """

    def __init__(self, flat: np.ndarray, vocabulary: int, expected: int, seed: int = 0):
        self.flat = flat.astype(np.float32)
        self.p = unflat(self.flat, vocabulary)
        self.m, self.s = ({k: np.zeros_like(v) for k, v in self.p.items() if k != "e"} for _ in range(2))
        self.seen = np.full(len(self.p["e"]), 1e-6, np.float32)
        self.rng = np.random.default_rng(seed)
        self.expected, self.t, self.windows = max(LEAST_STEPS, expected), 0, 0
        self.room = Room(self.flat.dtype)
        self.pool: list[np.ndarray] = []
        self.pooled = 0

    def feed(self, windows: np.ndarray) -> None:
        """windows (n, 2, WINDOW): inputs and outputs."""
        self.windows += len(windows)
        while len(windows):
            some, windows = windows[: POOL - self.pooled], windows[POOL - self.pooled :]
            self.pool.append(some)
            self.pooled += len(some)
            if self.pooled == POOL:
                self._pass()
                self.pool, self.pooled = [], 0

    def _pass(self) -> None:
        own = np.concatenate(self.pool)[self.rng.permutation(self.pooled)]
        for at in range(0, len(own), BATCH):
            self._step(own[at : at + BATCH, 0], own[at : at + BATCH, 1])

    def finish(self) -> np.ndarray:
        while self.pooled and (self.t < LEAST_STEPS or not self.t):
            self._pass()
            if self.t >= LEAST_STEPS:
                self.pooled = 0
        if self.pooled:
            self._pass()
        return self.flat

    def _step(self, x: np.ndarray, y: np.ndarray) -> None:
        _, g, rows, more = step(self.p, x, y, self.room)
        self.t += 1
        rate = max(0.1, 1 - 0.9 * self.t / (self.expected + 1))
        for k, v in g.items():
            self.m[k] += 0.1 * (v - self.m[k])
            self.s[k] += 0.01 * (v * v - self.s[k])
            self.p[k] -= RATE * rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.s[k] / (1 - 0.99**self.t)) + 1e-8)
        self.seen[rows] += (more * more).mean(axis=1)
        self.p["e"][rows] -= RATE_IN * rate * more / np.sqrt(self.seen[rows])[:, None]


def _padded(ids: np.ndarray, first: np.ndarray, size: np.ndarray, vocabulary: int) -> np.ndarray:
    """The inputs of all places: the subword before, or the start."""
    before = np.r_[np.int64(vocabulary), ids.astype(np.int64)[:-1]]
    before[first] = vocabulary
    return before


def training_windows(ids: np.ndarray, size: np.ndarray, outputs: Outputs) -> np.ndarray:
    """Windows (n, 2, WINDOW) over the whole of all sequences of size >= 1, one after the other; -1 behind the end."""
    first = np.cumsum(size) - size
    x = np.r_[_padded(ids, first, size, len(outputs.of)), np.zeros(WINDOW, np.int64)].astype(np.int32)
    y = np.r_[outputs.of[ids], np.full(WINDOW, -1)].astype(np.int32)
    n = -(-size // WINDOW)
    own = np.repeat(np.arange(len(size)), n)
    start = (np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    at = (first[own] + start)[:, None] + np.arange(WINDOW)
    real = np.arange(WINDOW) < (size[own] - start)[:, None]
    return np.stack([np.where(real, x[at], 0), np.where(real, y[at], -1)], axis=1)


class Scorer:
    """Log10 probabilities of whole sequences of subwords."""

    def __init__(self, flat: np.ndarray, outputs: Outputs):
        self.flat, self.outputs = flat.astype(np.float32), outputs
        self._prepare()

    def __getstate__(self) -> dict:
        return {"flat": self.flat, "outputs": self.outputs}  # tables are made anew where they are used

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def _prepare(self) -> None:
        p = unflat(self.flat, len(self.outputs.of))
        self.e = p["e"]
        self.wide = np.concatenate([p["q"] * np.float32(LOG2E * WIDTH**-0.5), p["k"], p["v"]], axis=1)
        self.outward = np.concatenate([p["out"], p["bias"][None]]) * np.float32(LOG2E)
        gap = np.arange(OVERLAP, WINDOW)[:, None] - np.arange(WINDOW)
        self.far = np.where(gap >= 0, p["far"][np.abs(gap)] * np.float32(LOG2E), np.float32(-1e9)).astype(np.float32)
        self.ones = np.ones(max(WINDOW, OUTPUTS), np.float32)
        self.both, self.out = np.ones((BLOCKS, STRIDE, 2 * WIDTH + 1), np.float32), np.empty((BLOCKS, STRIDE, OUTPUTS), np.float32)

    def score(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """ids: sequences one after the other, each of size >= 1 with its end. Every subword is scored once.

        A sequence's first window scores all its places. Each later one starts STRIDE tokens on and repeats OVERLAP tokens
        as context. As these are equally long, sequences are laid out in blocks of STRIDE tokens, and every block looks at
        itself and at the block before it, if that is of its sequence.
        """
        if not len(size):
            return np.zeros(0)
        ids, first = ids.astype(np.int64), np.cumsum(size) - size
        x = _padded(ids, first, size, len(self.outputs.of))
        total = np.add.reduceat(self.outputs.within[ids, self.outputs.kind[x]], first, dtype=np.float64)
        n = -(-size // STRIDE)
        start = np.cumsum(n) - n
        at = np.arange(len(ids)) + np.repeat((start + 1) * STRIDE - first, size)  # one block stands before all
        inputs, said = np.zeros((n.sum() + 1) * STRIDE, np.int64), np.zeros(n.sum() * STRIDE, np.float32)
        targets = np.zeros(len(said), np.int64)
        inputs[at], targets[at - STRIDE] = x, self.outputs.of[ids]
        begins = np.zeros(n.sum(), bool)
        begins[start] = True
        for b in range(0, len(begins), BLOCKS):
            stop = min(b + BLOCKS, len(begins))
            said[b * STRIDE : stop * STRIDE] = self._said(inputs[b * STRIDE : (stop + 1) * STRIDE], targets[b * STRIDE : stop * STRIDE], begins[b:stop])
        real = np.zeros(len(said), bool)
        real[at - STRIDE] = True
        said[~real] = 0
        return total + np.add.reduceat(said, start * STRIDE, dtype=np.float64) / np.log(10)

    def _said(self, inputs: np.ndarray, targets: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Log probability of each target of the blocks. inputs: theirs, after those of the block before the first."""
        e = self.e.take(inputs, axis=0)
        q, k, v = (m.reshape(-1, WIDTH) for m in _thirds(e.reshape(-1, STRIDE, WIDTH) @ self.wide))
        step, row = k.strides
        k, v = (np.lib.stride_tricks.as_strided(m, (len(begins), WINDOW, WIDTH), (STRIDE * step, step, row), writeable=False) for m in (k, v))
        a = q[STRIDE:].reshape(-1, STRIDE, WIDTH) @ k.transpose(0, 2, 1)
        a += self.far
        a[begins, :, :OVERLAP] = -1e9
        _exp2(a)
        both = self.both[: len(begins)]
        np.divide(a @ v, (a @ self.ones[:WINDOW])[:, :, None], out=both[:, :, :WIDTH])
        both[:, :, WIDTH:-1] = e[STRIDE:].reshape(len(begins), STRIDE, WIDTH)
        out = _exp2(np.matmul(both, self.outward, out=self.out[: len(begins)])).reshape(-1, OUTPUTS)
        return np.log(out[np.arange(len(out)), targets] / (out @ self.ones[:OUTPUTS]))


def texts_of(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, how many each text has) of texts' 16-bit ids."""
    return np.frombuffer(b"".join(packed), "<u2").astype(np.int64), np.fromiter((len(x) // 2 for x in packed), np.int64, len(packed))


def portions(packed: Iterator[bytes], tokens: int) -> Iterator[list[bytes]]:
    """Texts in lists of about so many tokens."""
    held, n = [], 0
    for x in packed:
        held.append(x)
        n += len(x) // 2
        if n >= tokens:
            yield held
            held, n = [], 0
    if held:
        yield held
