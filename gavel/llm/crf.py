"""Character-level bidirectional LSTM with CRF transitions, written in numpy.

`fit_batch` is used by the trainer only; `Tagger.emissions` and `Tagger.viterbi` run inside executors.
"""

from __future__ import annotations

import io

import numpy as np

KINDS = ("email", "phone", "id_number", "address", "name")
#: O, then B and I of each kind.
N_TAGS = 1 + 2 * len(KINDS)
#: Characters with an own embedding; every other one shares index 1, 0 is padding.
ALPHABET = "".join(map(chr, range(32, 127))) + "\n\táéíóúüñąćęłńóśźżÁÉÍÓÚÑŁŚŻ“”‘’–—«»"
_CODE = np.ones(0x110000, dtype=np.int16)
_CODE[0] = 0
for _i, _c in enumerate(dict.fromkeys(ALPHABET)):
    _CODE[ord(_c)] = _i + 2
N_CHARS = len(dict.fromkeys(ALPHABET)) + 2


def encode(text: str) -> np.ndarray:
    """Codes of the characters; surrogates and controls map to the shared unknown code."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.maximum(_CODE[codes], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def init(hidden: int, emb: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = {"E": rng.normal(0, 0.3, (N_CHARS, emb))}
    for d in "fb":
        p[f"W{d}"] = rng.normal(0, 1 / np.sqrt(emb), (emb, 4 * hidden))
        p[f"U{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        b = np.zeros(4 * hidden)
        b[hidden : 2 * hidden] = 1.0
        p[f"b{d}"] = b
    p["V"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, N_TAGS))
    p["c"] = np.zeros(N_TAGS)
    p["T"] = np.zeros((N_TAGS, N_TAGS))
    p["S"] = np.zeros(N_TAGS)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _lstm(x: np.ndarray, w, u, b, mask: np.ndarray, keep: bool):
    """x: (T, B, emb), mask: (T, B, 1). Returns the states (T, B, H) and, for training, the saved steps."""
    steps, batch, _ = x.shape
    hid = u.shape[0]
    if not keep:
        return _lstm_fast(x, w, u, b, mask), []
    z = (x.reshape(steps * batch, -1) @ w + b).reshape(steps, batch, -1)
    h = np.zeros((batch, hid), np.float32)
    c = np.zeros((batch, hid), np.float32)
    out = np.empty((steps, batch, hid), np.float32)
    saved = []
    for t in range(steps):
        g = z[t] + h @ u
        s = _sigmoid(g[:, : 3 * hid])
        i, f, o, n = s[:, :hid], s[:, hid : 2 * hid], s[:, 2 * hid :], np.tanh(g[:, 3 * hid :])
        c2 = f * c + i * n
        tc = np.tanh(c2)
        m = mask[t]
        h2 = o * tc
        if keep:
            saved.append((i, f, o, n, c, tc, h))
        c = m * c2 + (1 - m) * c
        h = m * h2 + (1 - m) * h
        out[t] = h
    return out, saved


def _lstm_fast(x: np.ndarray, w, u, b, mask: np.ndarray) -> np.ndarray:
    """The states alone: one tanh a step serves all gates, sigmoid(x) being (tanh(x/2) + 1)/2."""
    steps, batch, _ = x.shape
    hid = u.shape[0]
    half = np.ones(4 * hid, np.float32)
    half[: 3 * hid] = 0.5
    z = (x.reshape(steps * batch, -1) @ (w * half) + b * half).reshape(steps, batch, -1)
    u = u * half
    h, c = np.zeros((batch, hid), np.float32), np.zeros((batch, hid), np.float32)
    out = np.empty((steps, batch, hid), np.float32)
    for t in range(steps):
        g = z[t]
        g += h @ u
        np.tanh(g, out=g)
        s = g[:, : 3 * hid]
        s += 1.0
        s *= 0.5
        m = mask[t]
        whole = bool(m.all())
        c2 = s[:, hid : 2 * hid] * c
        c2 += s[:, :hid] * g[:, 3 * hid :]
        h2 = np.tanh(c2)
        h2 *= s[:, 2 * hid :]
        c = c2 if whole else m * c2 + (1 - m) * c
        h = h2 if whole else m * h2 + (1 - m) * h
        out[t] = h
    return out


def _lstm_back(dout, x, w, u, mask, saved):
    steps, batch, _ = x.shape
    hid = u.shape[0]
    dz = np.empty((steps, batch, 4 * hid), np.float32)
    du = np.zeros_like(u)
    dh = np.zeros((batch, hid), np.float32)
    dc = np.zeros((batch, hid), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, n, c, tc, h = saved[t]
        m = mask[t]
        dh_all = dout[t] + dh
        dh2 = dh_all * m
        dc2 = dc * m + dh2 * o * (1 - tc * tc)
        d = dz[t]
        d[:, :hid] = dc2 * n * i * (1 - i)
        d[:, hid : 2 * hid] = dc2 * c * f * (1 - f)
        d[:, 2 * hid : 3 * hid] = dh2 * tc * o * (1 - o)
        d[:, 3 * hid :] = dc2 * i * (1 - n * n)
        du += h.T @ d
        dh = d @ u.T + dh_all * (1 - m)
        dc = dc2 * f + dc * (1 - m)
    flat = dz.reshape(steps * batch, -1)
    return x.reshape(steps * batch, -1).T @ flat, du, flat.sum(0), (flat @ w.T).reshape(x.shape)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis))


def fit_batch(p: dict, codes: np.ndarray, tags: np.ndarray, lengths: np.ndarray, drop: float, rng) -> tuple[float, dict]:
    """Mean negative log-likelihood a character, and its gradients. codes, tags: (B, T)."""
    batch, steps = codes.shape
    mask = (np.arange(steps)[:, None] < lengths[None]).astype(np.float32)[:, :, None]
    x = p["E"][codes.T]
    hf, sf = _lstm(x, p["Wf"], p["Uf"], p["bf"], mask, True)
    hb, sb = _lstm(x[::-1], p["Wb"], p["Ub"], p["bb"], mask[::-1], True)
    h = np.concatenate([hf, hb[::-1]], 2)
    keep = (rng.random(h.shape, dtype=np.float32) >= drop).astype(np.float32) / (1 - drop)
    hd = h * keep
    e = hd @ p["V"] + p["c"]
    tr, st = p["T"], p["S"]
    alpha = np.empty_like(e)
    alpha[0] = st + e[0]
    for t in range(1, steps):
        a = _lse(alpha[t - 1][:, :, None] + tr[None], 1) + e[t]
        alpha[t] = np.where(mask[t] > 0, a, alpha[t - 1])
    beta = np.zeros_like(e)
    for t in range(steps - 2, -1, -1):
        b = _lse(tr[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        beta[t] = np.where(mask[t + 1] > 0, b, 0)
    z = _lse(alpha[-1], 1)
    y = tags.T
    rows = np.arange(batch)
    gold = st[y[0]] + e[0, rows, y[0]]
    for t in range(1, steps):
        gold = gold + mask[t, :, 0] * (tr[y[t - 1], y[t]] + e[t, rows, y[t]])
    total = float(lengths.sum())
    de = np.exp(alpha + beta - z[None, :, None]) * mask
    dst = de[0].sum(0)
    dtr = np.zeros_like(tr)
    for t in range(1, steps):
        q = np.exp(alpha[t - 1][:, :, None] + tr[None] + (e[t] + beta[t])[:, None, :] - z[:, None, None]) * mask[t][:, :, None]
        dtr += q.sum(0)
        np.add.at(dtr, (y[t - 1], y[t]), -mask[t, :, 0])
    np.add.at(dst, y[0], -1)
    onehot = np.zeros_like(e)
    np.put_along_axis(onehot, y[:, :, None], 1, 2)
    de -= onehot * mask
    de /= total
    flat = de.reshape(-1, N_TAGS)
    g = {"V": hd.reshape(-1, hd.shape[2]).T @ flat, "c": flat.sum(0), "T": dtr / total, "S": dst / total}
    dh = (flat @ p["V"].T).reshape(h.shape) * keep
    hid = p["Uf"].shape[0]
    g["Wf"], g["Uf"], g["bf"], dx = _lstm_back(dh[:, :, :hid], x, p["Wf"], p["Uf"], mask, sf)
    g["Wb"], g["Ub"], g["bb"], dxb = _lstm_back(dh[::-1, :, hid:], x[::-1], p["Wb"], p["Ub"], mask[::-1], sb)
    dx = dx + dxb[::-1]
    g["E"] = np.zeros_like(p["E"])
    np.add.at(g["E"], codes.T.ravel(), dx.reshape(-1, dx.shape[2]))
    return float((z - gold).sum() / total), g


class Tagger:
    """A trained model: windows are scored by the LSTM, their scores merged, and each whole text decoded once."""

    #: Characters of a window and of the step between windows.
    WINDOW, STRIDE = 256, 160

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = {k: np.ascontiguousarray(v, dtype=np.float32) for k, v in params.items()}

    @classmethod
    def load(cls, raw: bytes) -> "Tagger":
        with np.load(io.BytesIO(raw)) as z:
            return cls({k: z[k] for k in z.files})

    def _score(self, windows: list[np.ndarray]) -> list[np.ndarray]:
        """Tag scores of each window; windows of like length run together."""
        order = sorted(range(len(windows)), key=lambda k: len(windows[k]))
        out: list = [None] * len(windows)
        p = self.p
        for at in range(0, len(order), 256):
            ids = order[at : at + 256]
            steps = len(windows[ids[-1]])
            codes = np.zeros((len(ids), steps), np.int16)
            for r, k in enumerate(ids):
                codes[r, : len(windows[k])] = windows[k]
            mask = (codes.T > 0).astype(np.float32)[:, :, None]
            x = p["E"][codes.T]
            hf, _ = _lstm(x, p["Wf"], p["Uf"], p["bf"], mask, False)
            hb, _ = _lstm(x[::-1], p["Wb"], p["Ub"], p["bb"], mask[::-1], False)
            e = np.concatenate([hf, hb[::-1]], 2) @ p["V"] + p["c"]
            for r, k in enumerate(ids):
                out[k] = e[: len(windows[k]), r]
        return out

    def emissions(self, texts: list[str]) -> list[np.ndarray]:
        """Scores (length, tags) of each text. Where windows overlap, each counts by its distance from its own edges."""
        windows, spans = [], []
        for n, text in enumerate(texts):
            codes = encode(text)
            for at in range(0, max(1, len(codes) - (self.WINDOW - self.STRIDE)), self.STRIDE):
                windows.append(codes[at : at + self.WINDOW])
                spans.append((n, at))
        windows, spans = zip(*[(w, s) for w, s in zip(windows, spans) if len(w)]) if any(len(w) for w in windows) else ((), ())
        sums = [np.zeros((len(t), N_TAGS), np.float32) for t in texts]
        weights = [np.zeros((len(t), 1), np.float32) for t in texts]
        for (n, at), e in zip(spans, self._score(list(windows))):
            w = np.minimum(np.arange(1, len(e) + 1), np.arange(len(e), 0, -1)).astype(np.float32)[:, None]
            sums[n][at : at + len(e)] += w * e
            weights[n][at : at + len(e)] += w
        return [s / np.maximum(w, 1e-6) for s, w in zip(sums, weights)]

    def viterbi(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Best tag path of each text over its merged scores."""
        out: list = [None] * len(emissions)
        order = sorted(range(len(emissions)), key=lambda k: len(emissions[k]))
        tr, st = self.p["T"], self.p["S"]
        for at in range(0, len(order), 512):
            ids = order[at : at + 512]
            steps = max(1, len(emissions[ids[-1]]))
            e = np.zeros((steps, len(ids), N_TAGS), np.float32)
            n = np.array([len(emissions[k]) for k in ids])
            for r, k in enumerate(ids):
                e[: n[r], r] = emissions[k]
            best = st + e[0]
            back = np.zeros((steps, len(ids), N_TAGS), np.int8)
            rows = np.arange(len(ids))
            for t in range(1, steps):
                s = best[:, :, None] + tr[None]
                back[t] = s.argmax(1)
                best = np.where((t < n)[:, None], s.max(1) + e[t], best)
            tag = best.argmax(1)
            path = np.zeros((steps, len(ids)), np.int8)
            for t in range(steps - 1, -1, -1):
                path[t] = tag
                if t:
                    tag = np.where(t < n, back[t, rows, tag], tag)
            for r, k in enumerate(ids):
                out[k] = path[: n[r], r]
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of each detail, in text order."""
        found = []
        for path in self.viterbi(self.emissions(texts)):
            here: list[tuple[str, int, int]] = []
            start, kind = -1, 0
            for t, tag in enumerate([*path.tolist(), 0]):
                begins, k = tag % 2 == 1, (tag + 1) // 2
                if start >= 0 and (k != kind or begins):
                    here.append((KINDS[kind - 1], start, t))
                    start = -1
                if k and start < 0:
                    start, kind = t, k
            found.append(here)
        return found
