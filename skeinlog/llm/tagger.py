"""A character tagger in numpy: bidirectional LSTM, linear scores, CRF transitions."""

from __future__ import annotations

import numpy as np

#: Characters: printable ASCII, other white space, anything else, padding.
CODES = 98
_CODE = np.full(128, 95)
_CODE[32:127] = np.arange(95)
_CODE[9:14] = 96


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], 95)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, tags: int, size: int = 16, embedding: int = 12, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        self.tags, self.size = tags, size
        wide = embedding + size + 1
        self.p = {
            "embed": draw.normal(0, 0.3, (CODES, embedding)),
            "forward": draw.normal(0, wide**-0.5, (wide, 4 * size)),
            "backward": draw.normal(0, wide**-0.5, (wide, 4 * size)),
            "out": draw.normal(0, 0.3, (2 * size + 1, tags)),
            "move": np.zeros((tags, tags)),
        }

    def _run(self, x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, list]:
        """x: [time, window, embedding] to the states of each time, and what going back needs."""
        n, size = x.shape[1], self.size
        h, c, out, trace = np.zeros((n, size)), np.zeros((n, size)), [], []
        one = np.ones((n, 1))
        for t in range(len(x)):
            z = np.hstack([x[t], h, one])
            a = z @ w
            gate, cand = _sigmoid(a[:, : 3 * size]), np.tanh(a[:, 3 * size :])
            i, f, o = gate[:, :size], gate[:, size : 2 * size], gate[:, 2 * size :]
            before, c = c, f * c + i * cand
            tc = np.tanh(c)
            h = o * tc
            out.append(h)
            trace.append((z, i, f, o, cand, before, tc))
        return np.array(out), trace

    def _back(self, w: np.ndarray, trace: list, dh_all: np.ndarray, embedding: int) -> tuple[np.ndarray, np.ndarray]:
        size = self.size
        dw, dx = np.zeros_like(w), [np.zeros(0)] * len(trace)
        dh = dc = 0.0
        for t in reversed(range(len(trace))):
            z, i, f, o, cand, before, tc = trace[t]
            dh = dh + dh_all[t]
            dc = dc + dh * o * (1 - tc**2)
            da = np.hstack([dc * cand * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - cand**2)])
            dw += z.T @ da
            dz = da @ w.T
            dx[t], dh, dc = dz[:, :embedding], dz[:, embedding : embedding + size], dc * f
        return dw, np.array(dx)

    def _states(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, list]:
        x = self.p["embed"][chars.T]
        ahead, trace_a = self._run(x, self.p["forward"])
        behind, trace_b = self._run(x[::-1], self.p["backward"])
        both = np.concatenate([ahead, behind[::-1], np.ones((*ahead.shape[:2], 1))], axis=2)
        return both, both @ self.p["out"], trace_a, trace_b

    def scores(self, chars: np.ndarray) -> np.ndarray:
        """[window, time] to [window, time, tag], before transitions."""
        return self._states(chars)[1].transpose(1, 0, 2)

    def gradients(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags and its gradients."""
        both, s, trace_a, trace_b = self._states(chars)
        move, steps, n = self.p["move"], len(s), s.shape[1]
        alpha, beta = [s[0]], [np.zeros_like(s[0])]
        for t in range(1, steps):
            alpha.append(_lse(alpha[-1][:, :, None] + move[None], 1) + s[t])
        for t in range(steps - 2, -1, -1):
            beta.append(_lse(move[None] + (s[t + 1] + beta[-1])[:, None, :], 2))
        beta.reverse()
        total = _lse(alpha[-1], 1)
        hot = np.eye(self.tags)[tags.T]
        ds = (np.exp(np.array(alpha) + np.array(beta) - total[None, :, None]) - hot) / n
        dmove = np.zeros_like(move)
        for t in range(1, steps):
            pair = alpha[t - 1][:, :, None] + move[None] + (s[t] + beta[t])[:, None, :] - total[:, None, None]
            dmove += (np.exp(pair) - hot[t - 1][:, :, None] * hot[t][:, None, :]).sum(axis=0) / n
        gold = (s * hot).sum() + sum(move[tags[:, t - 1], tags[:, t]].sum() for t in range(1, steps))
        g = {"move": dmove, "out": np.einsum("tnh,tnk->hk", both, ds)}
        dboth = ds @ self.p["out"].T
        size, embedding = self.size, self.p["embed"].shape[1]
        g["forward"], dx = self._back(self.p["forward"], trace_a, dboth[:, :, :size], embedding)
        g["backward"], dxb = self._back(self.p["backward"], trace_b, dboth[::-1, :, size : 2 * size], embedding)
        g["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(g["embed"], chars.T, dx + dxb[::-1])
        return float((total.sum() - gold) / n), g

    def fit(self, chars: np.ndarray, tags: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01) -> "Tagger":
        draw = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(chars))
            for a in range(0, len(order), batch):
                at = order[a : a + batch]
                _, g = self.gradients(chars[at], tags[at])
                step += 1
                for k, d in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.99 * v[k] + 0.01 * d * d
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, s: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
        """Best tags of each sequence: s is [sequence, time, tag], each as long as length says."""
        best, back = s[:, 0], []
        final = best.copy()
        for t in range(1, s.shape[1]):
            paths = best[:, :, None] + self.p["move"][None]
            back.append(paths.argmax(axis=1))
            best = paths.max(axis=1) + s[:, t]
            final = np.where((length > t)[:, None], best, final)
        last = final.argmax(axis=1)
        out = []
        for k, n in enumerate(length.tolist()):
            tags = [int(last[k])]
            for t in range(n - 2, -1, -1):
                tags.append(int(back[t][k, tags[-1]]))
            out.append(np.array(tags[::-1]))
        return out
