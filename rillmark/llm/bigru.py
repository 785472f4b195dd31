"""A bidirectional gated recurrent network over bytes that labels every position, trained by backpropagation through time, in numpy.

The second direction reads each sequence reversed on its own, so both are padded on the right and no step needs a mask: what
follows a sequence's end never reaches a position before it. Gates are computed as (1 + tanh)/2.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

F32 = np.float32


@dataclass
class BiGRU:
    """Weights; the leading axis 2 is the direction. gate: update and reset (2H columns), cand: candidate state (H columns).

    wg (2, 256, 2H), wc (2, 256, H): one row per byte. ug (2, H, 2H), uc (2, H, H). wo (2H, L), bo (L). The byte rows
    carry the biases.
    """

    wg: np.ndarray
    wc: np.ndarray
    ug: np.ndarray
    uc: np.ndarray
    wo: np.ndarray
    bo: np.ndarray

    @staticmethod
    def new(hidden: int, labels: int, rng: np.random.Generator) -> BiGRU:
        h = hidden
        ortho = lambda: np.linalg.qr(rng.normal(size=(h, h)))[0]
        ug = np.stack([np.concatenate([ortho() * 0.5, ortho() * 0.5], axis=1) for _ in range(2)])
        parts = rng.normal(0, 0.15, (2, 256, 2 * h)), rng.normal(0, 0.3, (2, 256, h)), ug, np.stack([ortho(), ortho()]), rng.normal(0, 0.3, (2 * h, labels)), np.zeros(labels)
        return BiGRU(*[x.astype(F32) for x in parts])

    def params(self) -> list[np.ndarray]:
        return [self.wg, self.wc, self.ug, self.uc, self.wo, self.bo]

    def run(self, x: np.ndarray, keep: bool = False):
        """Hidden states (T+1, 2, B, H) for bytes ``x`` (2, B, T), the second direction reversed; with ``keep`` also each step's gates and candidate."""
        _, bsz, t_len = x.shape
        h = self.uc.shape[1]
        xt = np.ascontiguousarray(x.transpose(0, 2, 1))
        ag = np.stack([self.wg[0][xt[0]], self.wg[1][xt[1]]], axis=1)  # (T, 2, B, 2H)
        ac = np.stack([self.wc[0][xt[0]], self.wc[1][xt[1]]], axis=1)
        hs = np.zeros((t_len + 1, 2, bsz, h), F32)
        cs = np.empty((t_len, 2, bsz, h), F32) if keep else None
        g, c, half = np.empty((2, bsz, 2 * h), F32), np.empty((2, bsz, h), F32), F32(0.5)
        for t in range(t_len):
            now = hs[t]
            np.matmul(now, self.ug, out=g)
            a = ag[t]
            a += g
            np.tanh(a, out=a)
            a *= half
            a += half  # a: update, reset
            np.matmul(now, self.uc, out=c)
            if keep:
                cs[t] = c
            c *= a[..., h:]
            n = ac[t]
            n += c
            np.tanh(n, out=n)
            new = hs[t + 1]
            np.subtract(now, n, out=new)
            new *= a[..., :h]
            new += n
        return (hs, ag, ac, cs) if keep else hs

    def top(self, hs: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both directions' states side by side per position (T, B, 2H), and the index that turns the second around."""
        t_len, bsz = hs.shape[0] - 1, hs.shape[2]
        turn = np.clip(size[None, :] - 1 - np.arange(t_len)[:, None], 0, None)
        back = hs[1:, 1][turn, np.arange(bsz)[None, :]]
        return np.concatenate([hs[1:, 0], back], axis=2), turn

    def logp(self, top: np.ndarray) -> np.ndarray:
        """Log-probabilities (L, T*B): labels lead, so that sums over them are sums of long rows."""
        z = self.wo.T @ top.reshape(-1, top.shape[2]).T + self.bo[:, None]
        z -= z.max(0)
        z -= np.log(np.exp(z).sum(0))
        return z

    def grads(self, x: np.ndarray, size: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions and its gradients, through time in both directions."""
        hs, ag, ac, cs = self.run(x, keep=True)
        t_len, bsz, h = hs.shape[0] - 1, hs.shape[2], hs.shape[3]
        top, turn = self.top(hs, size)
        mask = (np.arange(t_len)[:, None] < size[None, :]).astype(F32)
        n_pos = F32(mask.sum())
        lp = self.logp(top).reshape(-1, t_len, bsz)
        who = np.arange(bsz)
        loss = float(-(lp[y, :, who].T * mask).sum() / n_pos)
        d = np.exp(lp)
        d[y, :, who] -= 1
        d *= mask / n_pos
        flat = d.reshape(len(d), -1)
        g_wo = (flat @ top.reshape(-1, 2 * h)).T
        g_bo = flat.sum(1)
        dtop = (flat.T @ self.wo.T).reshape(t_len, bsz, 2 * h)
        dhs = np.zeros((t_len, 2, bsz, h), F32)
        dhs[:, 0] = dtop[..., :h]
        live = mask.astype(bool)
        tt, bb = np.nonzero(live)
        dhs[turn[tt, bb], 1, bb] = dtop[tt, bb, h:]
        g_ug, g_uc = np.zeros_like(self.ug), np.zeros_like(self.uc)
        dag, dac = np.empty_like(ag), np.empty_like(ac)
        ugt, uct = self.ug.transpose(0, 2, 1), self.uc.transpose(0, 2, 1)
        back = np.zeros((2, bsz, h), F32)
        for t in range(t_len - 1, -1, -1):
            z, r, n, was = ag[t][..., :h], ag[t][..., h:], ac[t], hs[t]
            dh = dhs[t] + back
            dn = dh * (1 - z) * (1 - n * n)
            dac[t] = dn
            dag[t][..., :h] = dh * (was - n) * z * (1 - z) * 2  # the gate is (1 + tanh)/2: its slope is 2 g (1 - g)
            dag[t][..., h:] = dn * cs[t] * r * (1 - r) * 2
            dnr = dn * r
            wt = was.transpose(0, 2, 1)
            g_ug += wt @ dag[t]
            g_uc += wt @ dnr
            back = dh * z + dag[t] @ ugt + dnr @ uct
        out = []
        for dx, w in ((dag, self.wg), (dac, self.wc)):
            g_w = np.zeros_like(w)
            for k in (0, 1):
                ids = x[k].T.ravel()
                order = np.argsort(ids, kind="stable")
                s = ids[order]
                first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
                g_w[k][s[first]] = np.add.reduceat(dx[:, k].reshape(-1, dx.shape[3])[order], first)
            out.append(g_w)
        return loss, [*out, g_ug, g_uc, g_wo, g_bo]


def padded(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes (2, B, T), sizes): row 1 holds each sequence reversed; both are padded on the right."""
    size = np.array([len(s) for s in seqs])
    x = np.zeros((2, len(seqs), int(size.max())), np.uint8)
    for i, s in enumerate(seqs):
        a = np.frombuffer(s, np.uint8)
        x[0, i, : len(a)] = a
        x[1, i, : len(a)] = a[::-1]
    return x, size


def pooled(net: BiGRU, seqs: list[bytes], cells: int = 1 << 15) -> np.ndarray:
    """Sum over positions of the log-probabilities, one row per sequence; sequences of like length run together in blocks of about ``cells`` bytes."""
    out = np.zeros((len(seqs), len(net.bo)), np.float64)
    order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and (j - i + 1) * len(seqs[order[j]]) <= cells:
            j += 1
        j = max(j, i + 1)
        ids = order[i:j]
        if len(seqs[ids[-1]]):
            x, size = padded([seqs[k] for k in ids])
            top, _ = net.top(net.run(x), size)
            lp = net.logp(top).reshape(-1, *top.shape[:2])
            lp *= np.arange(top.shape[0])[:, None] < size[None, :]
            out[ids] = lp.sum(1).T
        i = j
    return out


def train(seqs: list[bytes], y: np.ndarray, labels: int, hidden: int = 24, steps: int = 350, batch: int = 96, window: int = 72, rate: float = 0.012, seed: int = 7, net: BiGRU | None = None) -> BiGRU:
    """Adam on random windows of the sequences, classes drawn evenly; the same input gives the same weights."""
    rng = np.random.default_rng(seed)
    net = net or BiGRU.new(hidden, labels, rng)
    by = [b for b in (np.flatnonzero(y == k) for k in range(labels)) if len(b)]
    m1, m2 = ([np.zeros_like(p) for p in net.params()] for _ in range(2))
    for step in range(1, steps + 1):
        ids = np.array([b[rng.integers(len(b))] for b in (by[k] for k in rng.integers(len(by), size=batch))])
        cut = []
        for i in ids:
            s = seqs[i]
            a = int(rng.integers(0, max(1, len(s) - window + 1)))
            cut.append(s[a : a + window])
        x, size = padded(cut)
        _, grads = net.grads(x, size, y[ids])
        norm = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in grads)))
        lr = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        for p, g, a, b in zip(net.params(), grads, m1, m2):
            g = g * F32(min(1.0, 1.0 / (norm + 1e-9)))
            a += F32(0.1) * (g - a)
            b += F32(0.01) * (g * g - b)
            p -= F32(lr) * (a / F32(1 - 0.9**step)) / (np.sqrt(b / F32(1 - 0.99**step)) + F32(1e-8))
    return net
