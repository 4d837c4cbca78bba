"""A character-level bidirectional LSTM with a CRF on top, in numpy: training and batch decoding."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

F32 = np.float32


@dataclass(frozen=True)
class Shape:
    alphabet: int
    tags: int
    embed: int = 12
    hidden: int = 20


@dataclass
class Tagger:
    """Tags each character of fixed-length windows; ``allowed[i, j]`` says if tag j may follow tag i."""

    shape: Shape
    allowed: np.ndarray
    first_allowed: np.ndarray
    p: dict = field(default_factory=dict)

    @classmethod
    def fresh(cls, shape: Shape, allowed: np.ndarray, first_allowed: np.ndarray, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *n: (rng.standard_normal(n) / np.sqrt(n[0])).astype(F32)
        a, k, e, h = shape.alphabet, shape.tags, shape.embed, shape.hidden
        p = {"emb": draw(a, e) * F32(2), "wo": draw(2 * h, k), "bo": np.zeros(k, F32), "tr": np.zeros((k, k), F32)}
        for d in "fb":
            p |= {f"wx{d}": draw(e, 4 * h), f"wh{d}": draw(h, 4 * h), f"b{d}": np.zeros(4 * h, F32)}
            p[f"b{d}"][h : 2 * h] = 1
        return cls(shape, allowed, first_allowed, p)

    def _direction(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states by step; x: [steps, batch] indices in the order of the direction."""
        n, h = self.shape.hidden, np.zeros((x.shape[1], self.shape.hidden), F32)
        c, wh = np.zeros_like(h), self.p[f"wh{d}"]
        table = self.p["emb"] @ self.p[f"wx{d}"] + self.p[f"b{d}"]
        half = np.full(4 * n, 0.5, F32)
        half[2 * n : 3 * n] = 1  # sigmoid(z) = (1 + tanh(z / 2)) / 2; the third gate is a plain tanh
        out, tape = np.empty((*x.shape, n), F32), []
        for t in range(len(x)):
            z = np.tanh((table[x[t]] + h @ wh) * half)
            i, f, o = (z[:, :n] + 1) * F32(0.5), (z[:, n : 2 * n] + 1) * F32(0.5), (z[:, 3 * n :] + 1) * F32(0.5)
            g = z[:, 2 * n : 3 * n]
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                tape.append((i, f, g, o, before, tc, h_before))
        return out, tape

    def _back(self, x: np.ndarray, d: str, tape: list, dout: np.ndarray, grad: dict) -> None:
        n, wh = self.shape.hidden, self.p[f"wh{d}"]
        dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
        dz_all = np.empty((*x.shape, 4 * n), F32)
        for t in reversed(range(len(x))):
            i, f, g, o, before, tc, _ = tape[t]
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = dz_all[t]
            dz[:, :n] = dc * g * i * (1 - i)
            dz[:, n : 2 * n] = dc * before * f * (1 - f)
            dz[:, 2 * n : 3 * n] = dc * i * (1 - g * g)
            dz[:, 3 * n :] = dh * tc * o * (1 - o)
            dh, dc = dz @ wh.T, dc * f
        flat = dz_all.reshape(-1, 4 * n)
        grad[f"wh{d}"] += np.concatenate([step[6] for step in tape]).T @ flat
        order = np.argsort(x.ravel(), kind="stable")
        chars, first = np.unique(x.ravel()[order], return_index=True)
        by_char = np.zeros((self.shape.alphabet, 4 * n), F32)
        by_char[chars] = np.add.reduceat(flat[order], first, axis=0)
        grad[f"wx{d}"] += self.p["emb"].T @ by_char
        grad[f"b{d}"] += by_char.sum(0)
        grad["emb"] += by_char @ self.p[f"wx{d}"].T

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """[batch, steps] indices to [steps, batch, tags] scores."""
        x = np.ascontiguousarray(x.T)
        f, _ = self._direction(x, "f", False)
        b, _ = self._direction(x[::-1], "b", False)
        return np.concatenate([f, b[::-1]], axis=2) @ self.p["wo"] + self.p["bo"]

    def _scores(self) -> tuple[np.ndarray, np.ndarray]:
        return np.where(self.allowed, self.p["tr"], F32(-1e4)), np.where(self.first_allowed, F32(0), F32(-1e4))

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tag marginals, expected transitions, log partition; forward and backward sums scaled at every step."""
        tr, first = self._scores()
        top = e.max(2, keepdims=True)
        own, move = np.exp(e - top), np.exp(tr)
        alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty(e.shape[:2], e.dtype)
        a = own[0] * np.exp(first)
        for t in range(len(e)):
            if t:
                a = (alpha[t - 1] @ move) * own[t]
            scale[t] = a.sum(1)
            alpha[t] = a / scale[t][:, None]
        for t in reversed(range(len(e) - 1)):
            beta[t] = ((own[t + 1] * beta[t + 1]) @ move.T) / scale[t + 1][:, None]
        k = e.shape[2]
        ahead = own[1:] * beta[1:] / scale[1:, :, None]
        pair = (alpha[:-1].reshape(-1, k).T @ ahead.reshape(-1, k)) * move
        return alpha * beta, pair, np.log(scale).sum(0) + top[:, :, 0].sum(0)

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Viterbi tags, [batch, steps]."""
        tr, first = self._scores()
        score, back = e[0] + first, np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            both = score[:, :, None] + tr
            back[t] = both.argmax(1)
            score = both.max(1) + e[t]
        tags = np.empty((e.shape[1], len(e)), np.int8)
        at = score.argmax(1)
        tags[:, -1] = at
        for t in reversed(range(1, len(e))):
            at = np.take_along_axis(back[t], at[:, None], 1)[:, 0]
            tags[:, t - 1] = at
        return tags

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
        xt, yt = np.ascontiguousarray(x.T), y.T
        f, tape_f = self._direction(xt, "f", True)
        b, tape_b = self._direction(xt[::-1], "b", True)
        both = np.concatenate([f, b[::-1]], axis=2)
        e = both @ self.p["wo"] + self.p["bo"]
        m, pair, z = self.marginals(e)
        gold = np.take_along_axis(e, yt[:, :, None], 2).sum() + self.p["tr"][yt[:-1], yt[1:]].sum()
        de = m
        np.put_along_axis(de, yt[:, :, None], np.take_along_axis(de, yt[:, :, None], 2) - 1, 2)
        np.add.at(pair, (yt[:-1], yt[1:]), -1)
        de, grad, n = (de / x.size).astype(F32), {k: np.zeros_like(v) for k, v in self.p.items()}, self.shape.hidden
        grad["tr"] += (pair / x.size) * self.allowed
        grad["wo"] += both.reshape(-1, 2 * n).T @ de.reshape(-1, de.shape[2])
        grad["bo"] += de.sum((0, 1))
        dboth = de @ self.p["wo"].T
        self._back(xt, "f", tape_f, dboth[:, :, :n], grad)
        self._back(xt[::-1], "b", tape_b, dboth[::-1, :, n:], grad)
        return grad, float(z.sum() - gold) / x.size

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int, rate: float, seed: int) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng, first, second, step, losses = np.random.default_rng(seed), {}, {}, 0, []
        for epoch in range(epochs):
            order, total = rng.permutation(len(x)), []
            pace = rate * (1 - 0.9 * epoch / epochs)
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                grad, loss = self.gradient(x[rows], y[rows])
                step += 1
                total.append(loss)
                for k, g in grad.items():
                    g = np.clip(g, -1, 1)
                    first[k] = F32(0.9) * first.get(k, 0) + F32(0.1) * g
                    second[k] = F32(0.99) * second.get(k, 0) + F32(0.01) * g * g
                    self.p[k] -= F32(pace) * (first[k] / F32(1 - 0.9**step)) / (np.sqrt(second[k] / F32(1 - 0.99**step)) + F32(1e-8))
            losses.append(float(np.mean(total)))
        return losses
