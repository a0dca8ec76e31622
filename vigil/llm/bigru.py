"""A bidirectional gated recurrent network with attention pooling, in numpy: scoring and training.

A word's input is its own embedding (none if the word is unknown) beside the mean of the embeddings of its
character trigrams. Both directions run as one stacked batch. Arrays are float32; shapes: L steps, B windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

#: Steps of training at least.
STEPS = 400
PUNCTUATION = b".,;:!?\"'()[]{}<>|*#$%&-_/\\`~+=^@"


@dataclass
class Model:
    """The network's sizes, its word list and its arrays."""

    vocabulary: dict[bytes, int]
    word: int = 8
    char: int = 8
    hidden: int = 8
    attention: int = 8
    buckets: int = 1 << 13
    shift: float = 0.0
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int) -> None:
        rng, h, d = np.random.default_rng(seed), self.hidden, self.word + self.char

        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "word": draw(len(self.vocabulary) + 1, self.word, scale=0.1),
            "char": draw(self.buckets, self.char, scale=0.3),
            "Wx": draw(2, d, 3 * h, scale=d**-0.5), "b": np.zeros((2, 1, 3 * h), np.float32),
            "U": draw(2, h, 3 * h, scale=h**-0.5),
            "Wa": draw(2 * h, self.attention, scale=(2 * h) ** -0.5), "ba": np.zeros(self.attention, np.float32),
            "v": draw(self.attention, scale=0.5),
            "wo": draw(2 * h, scale=0.5), "bo": np.zeros(1, np.float32),
        }
        self.p["word"][0] = 0

    # -- inputs ---------------------------------------------------------------------------------------------------
    def look_up(self, chunks: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of lower-case chunks: word rows (0: unknown), all trigram buckets in one array, and where each starts."""
        bare = [c.strip(PUNCTUATION) for c in chunks]
        words = np.fromiter((self.vocabulary.get(w, 0) for w in bare), np.int64, len(bare))
        # Each word stands between two marks, so that it has a trigram for each of its bytes at least.
        text = np.frombuffer(b"".join(b"\x01" + (w or b"\x03") + b"\x02" for w in bare), np.uint8).astype(np.int64)
        size = np.fromiter((max(1, len(w)) for w in bare), np.int64, len(bare))
        firsts = np.cumsum(size + 2) - (size + 2)
        at = np.arange(int(size.sum())) + np.repeat(firsts - (np.cumsum(size) - size), size)
        code = text[at] * 65599 + text[at + 1] * 257 + text[at + 2]
        return words, (code * 2654435761 >> 8) & (self.buckets - 1), np.cumsum(size) - size

    def inputs(self, chunks: Sequence[bytes]) -> np.ndarray:
        """(chunks, word + char) input vectors."""
        if not len(chunks):
            return np.zeros((0, self.word + self.char), np.float32)
        words, grams, first = self.look_up(chunks)
        size = np.diff(np.append(first, len(grams)))[:, None]
        out = np.empty((len(words), self.word + self.char), np.float32)
        out[:, :self.word] = self.p["word"][words]
        for lo in range(0, len(first), 1 << 14):  # bounded memory for the gathered trigrams
            hi = min(len(first), lo + (1 << 14))
            a, b = first[lo], first[hi] if hi < len(first) else len(grams)
            sums = np.add.reduceat(self.p["char"][grams[a:b]], first[lo:hi] - a, axis=0)
            out[lo:hi, self.word:] = sums / size[lo:hi]
        return out

    # -- scoring --------------------------------------------------------------------------------------------------
    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """x: (L, B, inputs), mask: (L, B) with 1 for a word. keep: filled with what training needs."""
        p, h = self.p, self.hidden
        steps, rows, d = x.shape
        flat = x.reshape(-1, d)
        a = np.stack([(flat @ p["Wx"][k] + p["b"][k]).reshape(steps, rows, 3 * h) for k in (0, 1)])
        a[1] = a[1, ::-1]
        m = np.stack([mask, mask[::-1]])[..., None]
        full = bool(mask.all())
        state = np.zeros((2, rows, h), np.float32)
        states = np.empty((2, steps, rows, h), np.float32)
        trace = []
        for t in range(steps):
            g = state @ p["U"]
            zr = a[:, t, :, :2 * h] + g[..., :2 * h]
            np.negative(zr, out=zr)
            np.exp(np.minimum(zr, 30, out=zr), out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[..., :h], zr[..., h:]
            n = np.tanh(a[:, t, :, 2 * h:] + r * g[..., 2 * h:])
            if keep is not None:
                trace.append((state, g[..., 2 * h:], z, r, n))
            new = n + z * (state - n)
            state = new if full else state + m[:, t] * (new - state)
            states[:, t] = state
        s = np.concatenate([states[0], states[1, ::-1]], axis=2)
        att = np.tanh(s @ p["Wa"] + p["ba"])
        e = np.where(mask > 0, att @ p["v"], np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        c = np.einsum("lb,lbh->bh", alpha, s)
        if keep is not None:
            keep |= {"x": x, "m": m, "trace": trace, "s": s, "att": att, "alpha": alpha, "c": c}
        return c @ p["wo"] + p["bo"][0]

    # -- training -------------------------------------------------------------------------------------------------
    def gradients(self, k: dict, out: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the arrays and of the inputs, from the loss's gradient of the logits."""
        p, h = self.p, self.hidden
        s, att, alpha, c, x = k["s"], k["att"], k["alpha"], k["c"], k["x"]
        g = {"wo": c.T @ out, "bo": np.array([out.sum()], np.float32)}
        dc = out[:, None] * p["wo"]
        dalpha = np.einsum("lbh,bh->lb", s, dc)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["v"] = np.einsum("lbk,lb->k", att, de)
        dpre = de[..., None] * p["v"] * (1 - att**2)
        g["Wa"] = np.einsum("lbh,lbk->hk", s, dpre, optimize=True)
        g["ba"] = dpre.sum(axis=(0, 1))
        ds = alpha[..., None] * dc + dpre @ p["Wa"].T
        ds = np.stack([ds[..., :h], ds[::-1, :, h:]])
        steps, rows = x.shape[:2]
        da = np.empty((2, steps, rows, 3 * h), np.float32)
        g["U"], back = np.zeros_like(p["U"]), np.zeros((2, rows, h), np.float32)
        for t in reversed(range(steps)):
            state, gn, z, r, n = k["trace"][t]
            d = ds[:, t] + back
            new = k["m"][:, t] * d
            back = d - new + new * z
            dn = new * (1 - z) * (1 - n**2)
            dz, dr = new * (state - n) * z * (1 - z), dn * gn * r * (1 - r)
            da[:, t] = np.concatenate([dz, dr, dn], axis=2)
            dg = np.concatenate([dz, dr, dn * r], axis=2)
            g["U"] += state.transpose(0, 2, 1) @ dg
            back += dg @ p["U"].transpose(0, 2, 1)
        da[1] = da[1, ::-1].copy()
        flat, da = x.reshape(-1, x.shape[2]), da.reshape(2, -1, 3 * h)
        g["Wx"] = np.stack([flat.T @ da[0], flat.T @ da[1]])
        g["b"] = da.sum(axis=1, keepdims=True)
        dx = da[0] @ p["Wx"][0].T + da[1] @ p["Wx"][1].T
        return g, dx.reshape(x.shape)

    def input_gradients(self, chunks: tuple[np.ndarray, np.ndarray, np.ndarray], index: np.ndarray,
                        dx: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the embeddings; index: (L, B) rows of the looked-up chunks."""
        words, grams, first = chunks
        per = np.zeros((len(words), dx.shape[2]), np.float32)
        np.add.at(per, index.ravel(), dx.reshape(-1, dx.shape[2]))
        g = {"word": np.zeros_like(self.p["word"]), "char": np.zeros_like(self.p["char"])}
        np.add.at(g["word"], words, per[:, :self.word])
        g["word"][0] = 0
        size = np.diff(np.append(first, len(grams)))
        used = np.flatnonzero(np.abs(per).sum(axis=1) > 0)
        at = np.concatenate([np.arange(first[i], first[i] + size[i]) for i in used.tolist()]) if len(used) else used
        np.add.at(g["char"], grams[at], np.repeat(per[used, self.word:] / size[used, None], size[used], axis=0))
        return g


class Adam:
    """Adam with decoupled weight decay."""

    def __init__(self, p: dict[str, np.ndarray], rate: float, decay: float):
        self.p, self.rate, self.decay, self.t = p, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            self.p[k] -= (self.rate * (m / (np.sqrt(v) + 1e-6) + self.decay * self.p[k])).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def number_windows(windows: list[bytes], length: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of windows (space-joined), each window's words as numbers, and 1 where it has one."""
    row: dict[bytes, int] = {}
    index = np.zeros((len(windows), length), np.int32)
    mask = np.zeros((len(windows), length), np.float32)
    for i, w in enumerate(windows):
        words = w.split() or [b""]
        index[i, :len(words)] = [row.setdefault(c, len(row)) for c in words]
        mask[i, :len(words)] = 1
    return list(row), index, mask


def train(model: Model, chunks: list[bytes], index: np.ndarray, mask: np.ndarray, doc: np.ndarray, label: np.ndarray,
          seed: int = 7, rounds: int = 10, batch: int = 128, rate: float = 0.01, decay: float = 0.01,
          hidden: float = 0.3) -> None:
    """Fit to documents' labels, of which only some windows show why.

    chunks, index, mask: from :func:`number_windows`; doc: each window's document (0 ..); label: of each document. In
    each round every document is stood for by its highest-scoring window, at first by that with the strongest word
    evidence.
    """
    rng, length = np.random.default_rng(seed), index.shape[1]
    looked = model.look_up(chunks)
    order = np.argsort(doc, kind="stable")
    firsts = np.flatnonzero(np.diff(doc[order], prepend=-1))
    docs = doc[order][firsts]

    def best(score: np.ndarray) -> np.ndarray:
        by = np.lexsort((-score, doc))
        return by[firsts]  # the same documents in the same order, each one's highest first

    # Smoothed log odds of known words by document; they start one dimension of the embeddings.
    words = len(model.vocabulary) + 1
    seen = np.unique(np.repeat(doc, length) * words + looked[0][index].ravel())
    n = [np.bincount((seen % words)[label[seen // words] == y], minlength=words) for y in (0, 1)]
    share = [(n[y] + 2) / (max(1, (label[docs] == y).sum()) + 4) for y in (0, 1)]
    odds = np.clip(np.log(share[1] / share[0]), -3, 3).astype(np.float32)
    odds[0] = 0
    model.p["word"][:, 0] = odds / 2
    del seen
    score = np.where(mask > 0, odds[looked[0][index]], np.float32(-9)).max(axis=1)
    opt = Adam(model.p, rate, decay)
    # Few documents: smaller batches and more rounds, so that there are some hundred steps in any case.
    batch = max(16, min(batch, len(firsts) // 40))
    for _ in range(max(rounds, -(-STEPS // max(1, len(firsts) // batch)))):
        chosen = best(score)
        for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // batch)):
            rows = chosen[part]
            at, m = index[rows].T, mask[rows].T
            x = model.inputs(chunks)[at] if len(chunks) < 1 << 12 else _inputs(model, looked, at)
            # Whole words are hidden now and then, so that characters and neighbours have to tell.
            hide = (rng.random(at.shape) < hidden)[..., None]
            x[..., :model.word] *= ~hide
            keep: dict = {}
            y = label[doc[rows]]
            out = ((sigmoid(model.logits(x, m, keep)) - y) / len(rows)).astype(np.float32)
            g, dx = model.gradients(keep, out)
            dx[..., :model.word] *= ~hide
            opt.step(g | model.input_gradients(looked, at, dx))
        every = model.inputs(chunks)
        score = np.concatenate([model.logits(every[index[i:i + 1024].T], mask[i:i + 1024].T)
                                for i in range(0, len(index), 1024)])


def _inputs(model: Model, looked: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Input vectors of the looked-up chunks that a batch holds."""
    words, grams, first = looked
    used, back = np.unique(at, return_inverse=True)
    size = np.diff(np.append(first, len(grams)))[used]
    rows = np.arange(int(size.sum())) + np.repeat(first[used] - (np.cumsum(size) - size), size)
    sums = np.add.reduceat(model.p["char"][grams[rows]], np.cumsum(size) - size, axis=0) / size[:, None]
    return np.concatenate([model.p["word"][words[used]], sums], axis=1)[back.reshape(at.shape)]
