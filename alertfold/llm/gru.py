"""A small bidirectional GRU with attention pooling, in numpy: forward, training, scoring.

A token's input joins a word vector (hashed word) and a character vector (the mean over
its hashed character 3- to 5-grams, with marks at the word's ends).  Two GRUs read a window
of tokens in both directions; attention weighs their states, the weighted mean gives the
window's logit.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 16
DIM, HIDDEN = 8, 8
PIECE, OVERLAP = 64, 4  # no 5-gram is lost between pieces
CACHE_WORDS = 120_000
TOKEN = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """The text's words; a run of more than ``PIECE`` word characters as overlapping pieces."""
    found = TOKEN.findall(text.lower()) if text else []
    if all(len(w) <= PIECE for w in found):
        return found
    step = PIECE - OVERLAP
    return [w[i:i + PIECE] for w in found for i in range(0, max(1, len(w) - OVERLAP), step)]


def word_bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word.encode()) % WORD_BUCKETS


def char_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) pairs of the words' character 3- to 5-grams, word by word within each
    length, with a mark at either end."""
    marked = [f"^{w}$" for w in words]
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))  # characters to the word's end
    of, bucket = [], []
    for n in (3, 4, 5):
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h + code[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        of.append(owner[at])
        bucket.append((h % np.uint64(CHAR_BUCKETS)).astype(np.int64))
    return np.concatenate(of), np.concatenate(bucket)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def mean_chars(table: np.ndarray, owner: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    """Mean vector of each word's n-grams."""
    total, count = np.zeros((n, DIM), np.float32), np.bincount(owner, minlength=n)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
    if len(starts):  # each length's pairs are in order of words, so a word has one run per length
        np.add.at(total, owner[starts], np.add.reduceat(table[bucket], starts, axis=0))
    return total / np.maximum(count, 1)[:, None].astype(np.float32)


class _Rows(dict):
    """Word -> place, in order of first use; ``new`` lists those not projected yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Gru:
    """Parameters in ``p``: names to float32 arrays."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.row = _Rows()
        # per direction and gate, a word's projected input
        self.inputs = [np.zeros((1024, HIDDEN), np.float32) for _ in range(6)]

    @staticmethod
    def fresh(rng: np.random.Generator) -> Gru:
        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)
        p = {"word": normal(WORD_BUCKETS, DIM, scale=0.05), "char": normal(CHAR_BUCKETS, DIM, scale=0.05),
             "att": normal(2 * HIDDEN, scale=0.1), "out": normal(2 * HIDDEN, scale=0.3),
             "bias": np.zeros(1, np.float32)}
        for d in "fb":
            p["x" + d] = normal(2 * DIM, 3 * HIDDEN, scale=0.3)
            p["c" + d] = np.zeros(3 * HIDDEN, np.float32)
            p["h" + d] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
        return Gru(p)

    # -- scoring ---------------------------------------------------------------------

    def rows(self, words: list[str]) -> np.ndarray:
        """Places of the words in ``inputs``; they hold until ``forget``."""
        got = np.fromiter(map(self.row.__getitem__, words), np.int32, len(words))
        return got

    def full(self) -> bool:
        return len(self.row) > CACHE_WORDS

    def forget(self) -> None:
        self.row.clear()
        self.row.new.clear()

    def project(self) -> None:
        """Inputs of the words that came since the last call.  The gates' inputs are halved:
        a sigmoid is taken as a tanh of half its argument."""
        new, p = self.row.new, self.p
        if not new:
            return
        start = len(self.row) - len(new)
        x = np.hstack([p["word"][[word_bucket(w) for w in new]], mean_chars(p["char"], *char_grams(new), len(new))])
        while start + len(new) > len(self.inputs[0]):
            self.inputs = [np.vstack([i, np.zeros_like(i)]) for i in self.inputs]
        for k, d in enumerate("fb"):
            got = x @ p["x" + d] + p["c" + d]
            for g, half in enumerate((0.5, 0.5, 1)):
                self.inputs[3 * k + g][start:start + len(new)] = half * got[:, g * HIDDEN:(g + 1) * HIDDEN]
        new.clear()

    def states(self, at: np.ndarray, active: np.ndarray, k: int) -> np.ndarray:
        """States of one direction; ``at[t, w]`` is the place of window w's t-th word."""
        r_in, z_in, n_in = self.inputs[3 * k:3 * k + 3]
        into = self.p["hfhb"[2 * k:2 * k + 2]]
        ur, uz, un = (np.ascontiguousarray(0.5 * into[:, g * HIDDEN:(g + 1) * HIDDEN]) for g in range(3))
        out = np.zeros((*at.shape, HIDDEN), np.float32)
        h = np.zeros((at.shape[1], HIDDEN), np.float32)
        for t, live in enumerate(active):
            h, i = h[:live], at[t, :live]
            r = r_in.take(i, axis=0)
            r += h @ ur
            np.tanh(r, out=r)
            r += 1                      # twice the reset gate; the half is in un
            r *= h @ un
            z = z_in.take(i, axis=0)
            z += h @ uz
            np.tanh(z, out=z)
            z += 1                      # twice the update gate
            n = n_in.take(i, axis=0)
            n += r
            np.tanh(n, out=n)
            z *= h - n
            z *= np.float32(0.5)
            n += z
            h = out[t, :live] = n
        return out

    def logits(self, index: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Logit of each window; ``index[w, t]`` is the place of its t-th word, ``length`` falls
        from window to window."""
        self.project()
        p, (n, steps) = self.p, index.shape
        active = np.searchsorted(-length, -np.arange(steps), "left")  # windows longer than t
        back = np.clip(length[:, None] - 1 - np.arange(steps), 0, None)
        heads = np.stack([p["att"], p["out"]], 1)
        forward = self.states(np.ascontiguousarray(index.T), active, 0) @ heads[:HIDDEN]
        turned = np.take_along_axis(index, back, axis=1)
        backward = self.states(np.ascontiguousarray(turned.T), active, 1) @ heads[HIDDEN:]
        both = forward + np.take_along_axis(backward, back.T[:, :, None], axis=0)
        mask = np.arange(steps)[:, None] < length
        score = np.where(mask, both[:, :, 0], -np.inf)
        weight = np.exp(score - score.max(0))
        return (weight * both[:, :, 1]).sum(0) / weight.sum(0) + p["bias"][0]

    # -- training --------------------------------------------------------------------

    def gradients(self, words: np.ndarray, grams: np.ndarray, gram_of: np.ndarray, length: np.ndarray,
                  y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients on padded windows ``words[w, t]`` (indices into a batch
        vocabulary whose word buckets are ``gram_of[:, 0]``) by back-propagation in time.

        ``grams`` holds (word of the batch vocabulary, character bucket) pairs.
        """
        p, (n, steps) = self.p, words.shape
        vocab = gram_of
        share = np.bincount(grams[0], minlength=len(vocab)).astype(np.float32)
        x_vocab = np.hstack([p["word"][vocab], mean_chars(p["char"], *grams, len(vocab))])
        mask = np.arange(steps)[:, None] < length[None, :]
        saved, states = {}, {}
        for d in "fb":
            at = words.T if d == "f" else np.take_along_axis(
                words, np.clip(length[:, None] - 1 - np.arange(steps), 0, None), axis=1).T
            ax = (x_vocab @ p["x" + d] + p["c" + d])
            h, keep = np.zeros((n, HIDDEN), np.float32), []
            out = np.zeros((steps, n, HIDDEN), np.float32)
            for t in range(steps):
                a, u = ax[at[t]], h @ p["h" + d]
                g = _sigmoid(a[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
                new = np.tanh(a[:, 2 * HIDDEN:] + g[:, :HIDDEN] * u[:, 2 * HIDDEN:])
                live = mask[t][:, None]
                nxt = np.where(live, new + g[:, HIDDEN:] * (h - new), h)
                keep.append((h, u, g, new, live))
                h = nxt
                out[t] = h
            saved[d], states[d] = (at, keep), out
        turn = np.clip(length[None, :] - 1 - np.arange(steps)[:, None], 0, None)
        cols = np.arange(n)[None, :]
        state = np.concatenate([states["f"], states["b"][turn, cols]], axis=2)
        score = np.where(mask, state @ p["att"], -np.inf)
        alpha = np.exp(score - score.max(0))
        alpha /= alpha.sum(0)
        value = state @ p["out"]
        logit = (alpha * value).sum(0) + p["bias"][0]
        prob = _sigmoid(logit)
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / weight.sum())
        d_logit = weight * (prob - y) / weight.sum()
        grad = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char")}
        grad["bias"][0] = d_logit.sum()
        d_value = alpha * d_logit
        d_score = alpha * (value - (alpha * value).sum(0)) * d_logit
        grad["out"] = np.einsum("tn,tnk->k", d_value, state).astype(np.float32)
        grad["att"] = np.einsum("tn,tnk->k", np.where(mask, d_score, 0), state).astype(np.float32)
        d_state = (d_value[..., None] * p["out"] + d_score[..., None] * p["att"]).astype(np.float32)
        d_state[~mask] = 0
        d_x = np.zeros_like(x_vocab)
        for d, half in (("f", 0), ("b", HIDDEN)):
            at, keep = saved[d]
            part = d_state[:, :, half:half + HIDDEN]
            part = part if d == "f" else np.where(mask[..., None], part[turn, cols], 0)
            into = np.zeros((steps, n, 3 * HIDDEN), np.float32)
            d_h = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1):
                h, u, g, new, live = keep[t]
                d_h = d_h + part[t]
                d_in = np.where(live, d_h, 0)
                r, z = g[:, :HIDDEN], g[:, HIDDEN:]
                d_new = d_in * (1 - z) * (1 - new * new)
                d_z = d_in * (h - new) * z * (1 - z)
                d_r = d_new * u[:, 2 * HIDDEN:] * r * (1 - r)
                d_a = np.hstack([d_r, d_z, d_new])
                d_u = np.hstack([d_r, d_z, d_new * r])
                into[t] = d_a
                grad["h" + d] += h.T @ d_u
                d_h = np.where(live, d_in * z + d_u @ p["h" + d].T, d_h)
            order = np.argsort(at, axis=None, kind="stable")
            placed = at.reshape(-1)[order]
            starts = np.flatnonzero(np.r_[True, placed[1:] != placed[:-1]])
            d_ax = np.zeros((len(vocab), 3 * HIDDEN), np.float32)
            d_ax[placed[starts]] = np.add.reduceat(into.reshape(-1, 3 * HIDDEN)[order], starts, axis=0)
            grad["x" + d] = x_vocab.T @ d_ax
            grad["c" + d] = d_ax.sum(0)
            d_x += d_ax @ p["x" + d].T
        return loss, grad | {"d_word": d_x[:, :DIM], "d_char": d_x[:, DIM:] / share[:, None]}


def train(windows: list, y: np.ndarray, steps: int = 500, batch: int = 64, rate: float = 0.01,
          seed: int = 3) -> Gru:
    """Fit on windows of words (lists, or texts with a space between words) with labels, by Adam;
    classes are drawn in equal shares.  Texts are split one at a time, so that their words are
    held once."""
    rng = np.random.default_rng(seed)
    net = Gru.fresh(rng)
    p = net.p
    def split(win):
        return win.split(" ") if isinstance(win, str) else win

    ids = {w: i for i, w in enumerate(dict.fromkeys(w for win in windows for w in split(win)))}
    names = list(ids)
    buckets = np.array([word_bucket(w) for w in names], np.int64)
    of, bucket = char_grams(names)
    of, bucket = (x[np.argsort(of, kind="stable")] for x in (of, bucket))
    grams = np.split(bucket, np.flatnonzero(of[1:] != of[:-1]) + 1)
    coded = [np.array([ids[w] for w in split(win)], np.int32) for win in windows]
    _informed_start(net, coded, y, buckets, grams)
    of_class = [np.flatnonzero(y == c) for c in (0, 1)]
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(c, batch // 2) for c in of_class])
        length = np.array([len(coded[i]) for i in pick])
        padded = np.zeros((len(pick), length.max()), np.int64)
        for k, i in enumerate(pick):
            padded[k, :length[k]] = coded[i]
        used, local = np.unique(padded, return_inverse=True)
        local = local.reshape(padded.shape)
        sizes = [len(grams[i]) for i in used]
        pairs = (np.repeat(np.arange(len(used)), sizes), np.concatenate([grams[i] for i in used]))
        _, g = net.gradients(local, pairs, buckets[used], length, y[pick].astype(np.float32),
                             np.ones(len(pick), np.float32))
        for k in first:
            if k in ("word", "char"):
                rows = buckets[used] if k == "word" else pairs[1]
                full = g["d_word"] if k == "word" else g["d_char"][pairs[0]]
                touched, back = np.unique(rows, return_inverse=True)
                grad = np.zeros((len(touched), DIM), np.float32)
                np.add.at(grad, back, full)
            else:
                touched, grad = slice(None), g[k]
            first[k][touched] = 0.9 * first[k][touched] + 0.1 * grad
            second[k][touched] = 0.99 * second[k][touched] + 0.01 * grad * grad
            size = rate * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step) * (1 - 0.8 * step / steps)
            p[k][touched] -= size * (first[k][touched] / (np.sqrt(second[k][touched]) + 1e-8)
                                     + (0.01 * p[k][touched] if k in ("word", "char") else 0))
    return Gru(p)


def _informed_start(net: Gru, coded, y, buckets, grams) -> None:
    """The first dimension of both vectors starts at how strongly their windows' labels
    lean, in standard errors, so rare words start near 0."""
    for name, of in (("word", [np.array([b]) for b in buckets]), ("char", grams)):
        count = np.zeros((2, len(net.p[name])))
        for win, label in zip(coded, y):
            if len(win):
                count[int(label), np.unique(np.concatenate([of[i] for i in np.unique(win)]))] += 1
        total = np.bincount(y.astype(int), minlength=2)[:, None] + 1.0
        odds = [np.log((count[c] + 0.5) / (total[c, 0] - count[c] + 0.5)) for c in (0, 1)]
        error = np.sqrt(1 / (count[1] + 0.5) + 1 / (count[0] + 0.5))
        net.p[name][:, 0] = np.tanh((odds[1] - odds[0]) / error / 4)
