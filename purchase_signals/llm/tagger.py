"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Arrays run time first: (time, window, features).  ``Tagger`` holds the weights,
``train`` fits them to labelled windows by Adam on the CRF's negative log
likelihood, ``decode`` gives the best tag path of many windows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tag 0 is outside; kind k begins with tag 2k + 1 and goes on with 2k + 2.
TAGS = 2 * len(KINDS) + 1
HIDDEN = 24
#: Character classes: 0 padding, then the marks that matter one by one, then
#: digits, small and capital letters, white space, line ends, the letters of
#: "at" and "dot", and the rest.
MARKS = "@.+-()_%,:/[]{}"
LETTERS = "atdo"
CLASSES = len(MARKS) + len(LETTERS) + 7


def class_table() -> np.ndarray:
    """Character class by code point; the last entry serves all higher ones."""
    out = np.full(0x3001, CLASSES - 1, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        if c in MARKS:
            out[i] = MARKS.index(c) + 1
        elif "0" <= c <= "9":
            out[i] = len(MARKS) + 1
        elif c in LETTERS:
            out[i] = len(MARKS) + 6 + LETTERS.index(c)
        elif c in "\r\n":
            out[i] = len(MARKS) + 5
        elif c.islower():
            out[i] = len(MARKS) + 2
        elif c.isupper():
            out[i] = len(MARKS) + 3
        elif c.isspace():
            out[i] = len(MARKS) + 4
    return out


DIGIT = len(MARKS) + 1


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def allowed() -> np.ndarray:
    """0 where one tag may follow another, else a very low score: a kind goes on
    only behind itself.  The last row is for a window's first tag, where a span
    may already be under way."""
    out = np.zeros((TAGS + 1, TAGS), np.float32)
    for k in range(len(KINDS)):
        out[:TAGS, 2 * k + 2] = -1e4
        out[[2 * k + 1, 2 * k + 2], 2 * k + 2] = 0
    return out


@dataclass
class Tagger:
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w[f"x{side}"] = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN))
            w[f"x{side}"][:, HIDDEN:2 * HIDDEN] += 1  # forget gates start open
            w[f"h{side}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        w["out"] = rng.normal(0, 0.2, (2 * HIDDEN, TAGS))
        w["bias"] = np.zeros(TAGS)
        w["move"] = np.zeros((TAGS + 1, TAGS))
        return Tagger({k: v.astype(np.float32) for k, v in w.items()})

    def emissions(self, x: np.ndarray, keep: bool = True) -> tuple[np.ndarray, dict]:
        """Scores of the tags, and what the gradient needs if ``keep``."""
        w = self.weights
        hf, kept_f = lstm(w["xf"], x, w["hf"], keep)
        hb, kept_b = lstm(w["xb"], x[::-1], w["hb"], keep)
        h = np.concatenate([hf, hb[::-1]], axis=2)
        return h @ w["out"] + w["bias"], {"h": h, "f": kept_f, "b": kept_b}

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags (time, window) of character classes (time, window)."""
        e, _ = self.emissions(x, keep=False)
        move = self.weights["move"] + allowed()
        steps, best = len(x), e[0] + move[TAGS]
        back = np.empty((steps, *best.shape), np.int8)
        for t in range(1, steps):
            s = best[:, :, None] + move[None, :TAGS]
            back[t] = s.argmax(1)
            best = s.max(1) + e[t]
        tags = np.empty(x.shape, np.int8)
        tags[-1] = best.argmax(1)
        rows = np.arange(x.shape[1])
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t, rows, tags[t]]
        return tags


def lstm(table: np.ndarray, x: np.ndarray, u: np.ndarray, keep: bool) -> tuple[np.ndarray, tuple | None]:
    """Hidden states for character classes ``x`` (time, window) with the input
    weights ``table``, and what the gradient needs if ``keep``."""
    n, dtype = HIDDEN, u.dtype
    h = np.zeros((x.shape[1], n), dtype)
    c = np.zeros_like(h)
    hs = np.empty((len(x), *h.shape), dtype)
    cs, gates = (np.empty_like(hs), np.empty((*x.shape, 4 * n), dtype)) if keep else (None, None)
    for t in range(len(x)):
        z = table[x[t]] + h @ u
        z[:, :3 * n] = sigmoid(z[:, :3 * n])
        z[:, 3 * n:] = np.tanh(z[:, 3 * n:])
        c = z[:, n:2 * n] * c + z[:, :n] * z[:, 3 * n:]
        h = z[:, 2 * n:3 * n] * np.tanh(c)
        hs[t] = h
        if keep:
            cs[t], gates[t] = c, z
    return hs, (hs, cs, gates) if keep else None


def lstm_gradient(dh_out: np.ndarray, u: np.ndarray, kept: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input sums and of ``u``."""
    hs, cs, gates = kept
    n, du = HIDDEN, np.zeros_like(u)
    dx = np.empty_like(gates)
    dh, dc = np.zeros_like(hs[0]), np.zeros_like(hs[0])
    for t in range(len(hs) - 1, -1, -1):
        i, f, o, g = (gates[t][:, k * n:(k + 1) * n] for k in range(4))
        tc = np.tanh(cs[t])
        dh = dh + dh_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        before = cs[t - 1] if t else np.zeros_like(cs[0])
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dx[t] = dz
        if t:
            du += hs[t - 1].T @ dz
        dh, dc = dz @ u.T, dc * f
    return dx, du


def logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)


def crf_gradient(e: np.ndarray, move: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood and its gradients by emissions and transitions."""
    steps, n, _ = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0] + move[TAGS]
    for t in range(1, steps):
        alpha[t] = logsumexp(alpha[t - 1][:, :, None] + move[None, :TAGS], 1) + e[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = logsumexp(move[None, :TAGS] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    total = logsumexp(alpha[-1], 1)
    de = np.exp(alpha + beta - total[:, None])
    dmove = np.zeros_like(move)
    dmove[TAGS] = de[0].sum(0)
    rows = np.arange(n)
    gold = e[0][rows, tags[0]] + move[TAGS][tags[0]]
    np.add.at(dmove, (np.full(n, TAGS), tags[0]), -1)
    de[0][rows, tags[0]] -= 1
    for t in range(1, steps):
        pair = alpha[t - 1][:, :, None] + move[None, :TAGS] + (e[t] + beta[t])[:, None, :] - total[:, None, None]
        dmove[:TAGS] += np.exp(pair).sum(0)
        gold += e[t][rows, tags[t]] + move[tags[t - 1], tags[t]]
        np.add.at(dmove, (tags[t - 1], tags[t]), -1)
        de[t][rows, tags[t]] -= 1
    return float((total - gold).mean()), de / n, dmove / n


def gradients(tagger: Tagger, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    w = tagger.weights
    e, kept = tagger.emissions(x)
    loss, de, dmove = crf_gradient(e, w["move"] + allowed(), tags)
    out = {"move": dmove, "bias": de.sum((0, 1)), "out": np.einsum("tbh,tbk->hk", kept["h"], de)}
    dh = de @ w["out"].T
    for side, part, order in (("f", dh[:, :, :HIDDEN], slice(None)), ("b", dh[:, :, HIDDEN:], slice(None, None, -1))):
        dx, du = lstm_gradient(part[order], w[f"h{side}"], kept[side])
        table = np.zeros_like(w[f"x{side}"])
        np.add.at(table, x[order].ravel(), dx.reshape(-1, 4 * HIDDEN))
        out[f"x{side}"], out[f"h{side}"] = table, du
    return loss, out


def train(x: np.ndarray, tags: np.ndarray, steps: int = 360, batch: int = 64, rate: float = 0.02, seed: int = 5) -> Tagger:
    """Fit to windows: ``x`` and ``tags`` are (window, time)."""
    tagger, rng = Tagger.fresh(), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    v2 = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), batch)
        _, grad = gradients(tagger, x[pick].T, tags[pick].T)
        norm = max(1.0, np.sqrt(sum(float((g * g).sum()) for g in grad.values())) / 5)
        decay = rate * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            g = g / norm
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.99 * v2[k] + 0.01 * g * g
            tagger.weights[k] -= (decay * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return tagger
