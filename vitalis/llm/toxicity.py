"""Toxicity: a small bidirectional gated recurrent network.

Each word enters as a learned word vector plus the mean vector of its
character trigrams; two recurrent passes, attention pooling over the steps
and a logistic output score a window of words. A text is cut into overlapping
windows that cover every word, and scores as its most toxic window. The
network is trained in numpy on a bounded sample of labelled windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import bounded_sample, id_text, is_held_out, named, slices

#: Words in a window, and from one window's start to the next.
WIDTH, STRIDE = 32, 16
HIDDEN, DIM, TRIGRAMS = 8, 8, 1 << 12
EDGE = ".,;:!?\"'()[]{}<>*#$%&|-_"
#: Windows that go through the network at once.
BATCH = 4096
Weights = dict[str, np.ndarray]


def windows(n: int) -> np.ndarray:
    """Start and length of the windows over ``n`` words: every ``STRIDE``
    words, the last one ending with the text."""
    if n <= WIDTH:
        return np.array([[0, n]])
    starts = np.arange(0, n - WIDTH + STRIDE, STRIDE)
    starts[-1] = n - WIDTH
    return np.column_stack([np.unique(starts), np.full(len(np.unique(starts)), WIDTH)])


def normal_form(word: str) -> str:
    return word.strip(EDGE)


def trigram_lists(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of the padded words, all in a row, and the number
    of each word (one at least)."""
    raw = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    codes = np.frombuffer(b"".join(raw) + b"\0\0", np.uint8).astype(np.uint32)
    h = (codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h = (h >> np.uint32(20)).astype(np.int64)
    number = np.maximum(size - 2, 1)
    start = np.cumsum(size) - size
    inside = np.repeat(start - (np.cumsum(number) - number), number) + np.arange(number.sum())
    return h[inside], number


def inputs(w: Weights, ids: np.ndarray, grams: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Word vector beside mean trigram vector, for each distinct word."""
    first = np.cumsum(number) - number
    chars = np.add.reduceat(w["chars"][grams], first, axis=0) / number[:, None] if len(ids) else np.zeros((0, DIM))
    return np.concatenate([w["words"][ids], chars], 1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _pass(gates: np.ndarray, at: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool,
          keep: bool = False) -> tuple[np.ndarray, list]:
    """States of one direction, steps by windows by units; ``keep`` holds what
    the gradient needs. A masked step leaves the state as it was."""
    steps, n = at.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out, kept = np.empty((steps, n, HIDDEN), np.float32), [None] * steps
    for t in (range(steps - 1, -1, -1) if back else range(steps)):
        g = gates[at[t]]
        hu = h @ u
        rz = _sigmoid(g[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
        r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
        c = np.tanh(g[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
        new = c + z * (h - c)
        if keep:
            kept[t] = (h, r, z, c, hu[:, 2 * HIDDEN:])
        m = mask[t]
        h = new if m.all() else np.where(m[:, None], new, h)
        out[t] = h
    return out, kept


def forward(w: Weights, x: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logit of each window; ``at`` (steps by windows) are rows of ``x``."""
    f, kf = _pass(x @ w["in_f"] + w["bias_f"], at, mask, w["u_f"], False, keep)
    b, kb = _pass(x @ w["in_b"] + w["bias_b"], at, mask, w["u_b"], True, keep)
    h = np.concatenate([f, b], 2)
    e = np.tanh(h @ w["att"] + w["att_b"])
    s = np.where(mask, e @ w["att_v"], -1e9)
    a = np.exp(s - s.max(0)) * mask
    a = a / np.maximum(a.sum(0), 1e-9)
    context = (a[:, :, None] * h).sum(0)
    logit = context @ w["out"] + w["out_b"]
    return logit, (h, e, a, context, kf, kb)


def _back_pass(dh_all, gates_n, at, mask, u, kept, back):
    steps, n = at.shape
    du, dgates = np.zeros_like(u), np.zeros((gates_n, 3 * HIDDEN), np.float32)
    carry = np.zeros((n, HIDDEN), np.float32)
    flat_at, flat_g = [], []
    for t in (range(steps) if back else range(steps - 1, -1, -1)):
        h, r, z, c, hn = kept[t]
        m = mask[t][:, None]
        d = dh_all[t] + carry
        dn = d * m
        dz = dn * (h - c) * z * (1 - z)
        dc = dn * (1 - z) * (1 - c * c)
        dr = dc * hn * r * (1 - r)
        g = np.concatenate([dr, dz, dc * r], 1)
        du += h.T @ g
        carry = d * (1 - m) + dn * z + g @ u.T
        flat_at.append(at[t])
        flat_g.append(np.concatenate([dr, dz, dc], 1))
    index, grad = np.concatenate(flat_at), np.concatenate(flat_g)
    for k in range(3 * HIDDEN):
        dgates[:, k] = np.bincount(index, weights=grad[:, k], minlength=gates_n)
    return du, dgates


def gradients(w: Weights, ids, grams, number, at, mask, label, weight) -> tuple[float, Weights]:
    """Weighted logistic loss and its gradient in every weight."""
    x = inputs(w, ids, grams, number)
    logit, (h, e, a, context, kf, kb) = forward(w, x, at, mask, keep=True)
    p = _sigmoid(logit)
    loss = float((weight * (np.logaddexp(0, logit) - label * logit)).sum())
    dl = (weight * (p - label)).astype(np.float32)
    g: Weights = {"out": context.T @ dl, "out_b": dl.sum(keepdims=True)}
    dctx = dl[:, None] * w["out"]
    dh = a[:, :, None] * dctx
    da = (h * dctx).sum(2)
    ds = a * (da - (a * da).sum(0))
    de = ds[:, :, None] * w["att_v"] * (1 - e * e)
    g["att_v"] = (ds[:, :, None] * e).sum((0, 1))
    g["att"] = np.einsum("tni,tnj->ij", h, de)
    g["att_b"] = de.sum((0, 1))
    dh = dh + de @ w["att"].T
    dx = np.zeros_like(x)
    for side, part, kept in (("f", dh[:, :, :HIDDEN], kf), ("b", dh[:, :, HIDDEN:], kb)):
        g["u_" + side], dg = _back_pass(part, len(x), at, mask, w["u_" + side], kept, side == "b")
        g["in_" + side], g["bias_" + side] = x.T @ dg, dg.sum(0)
        dx += dg @ w["in_" + side].T
    g["words"], g["chars"] = np.zeros_like(w["words"]), np.zeros_like(w["chars"])
    each = np.repeat(dx[:, DIM:] / number[:, None], number, axis=0)
    for k in range(DIM):
        g["words"][:, k] = np.bincount(ids, weights=dx[:, k], minlength=len(w["words"]))
        g["chars"][:, k] = np.bincount(grams, weights=each[:, k], minlength=TRIGRAMS)
    return loss, g


def start_weights(n_words: int, rng: np.random.Generator) -> Weights:
    draw = lambda *s, by=0.3: (rng.standard_normal(s) * by).astype(np.float32)
    w = {"words": draw(n_words, DIM, by=0.05), "chars": draw(TRIGRAMS, DIM, by=0.05), "att": draw(2 * HIDDEN, HIDDEN), "att_b": draw(HIDDEN, by=0),
         "att_v": draw(HIDDEN), "out": draw(2 * HIDDEN), "out_b": np.full(1, -1.0, np.float32)}
    for side in "fb":
        w |= {"in_" + side: draw(2 * DIM, 3 * HIDDEN), "bias_" + side: draw(3 * HIDDEN, by=0), "u_" + side: draw(HIDDEN, 3 * HIDDEN)}
    return w


class Encoded:
    """Windows as rows of distinct words, ready for the network."""

    def __init__(self, vocabulary: dict[str, int], texts: Iterable[list[str]]):
        index: dict[str, int] = {}
        at, mask, self.owner = [], [], []
        for k, words in enumerate(texts):
            codes = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
            spans = windows(len(words))
            grid = np.minimum(spans[:, :1] + np.arange(WIDTH), max(0, len(words) - 1))
            at.append((codes[grid] if len(words) else np.zeros_like(grid)).astype(np.int32))
            mask.append(np.arange(WIDTH) < spans[:, 1:])
            self.owner.append(np.full(len(spans), k))
        if not index:
            index[""] = 0
        forms = [normal_form(w) for w in index]
        self.ids = np.fromiter((vocabulary.get(f, 0) for f in forms), np.int64, len(forms))
        self.grams, self.number = trigram_lists(forms)
        self.at, self.mask = np.concatenate(at), np.concatenate(mask)
        self.owner = np.concatenate(self.owner)

    def subset(self, rows: np.ndarray):
        """Arguments of :func:`gradients` for some windows."""
        used, at = np.unique(self.at[rows], return_inverse=True)
        first = np.cumsum(self.number) - self.number
        number = self.number[used]
        inside = np.repeat(first[used] - (np.cumsum(number) - number), number) + np.arange(number.sum())
        return self.ids[used], self.grams[inside], number, at.reshape(len(rows), WIDTH).T, self.mask[rows].T


class Network:
    """Weights, the word vocabulary and the calibration of a text's score."""

    def __init__(self, vocabulary: dict[str, int], weights: Weights):
        self.vocabulary, self.weights, self.scale = vocabulary, weights, (1.0, 0.0)

    def window_logits(self, data: Encoded) -> np.ndarray:
        x = inputs(self.weights, data.ids, data.grams, data.number)
        out = np.empty(len(data.at), np.float32)
        for k in range(0, len(out), BATCH):
            out[k:k + BATCH] = forward(self.weights, x, data.at[k:k + BATCH].T, data.mask[k:k + BATCH].T)[0]
        return out

    def text_logits(self, texts: list[list[str]]) -> np.ndarray:
        """The largest window logit of each text."""
        data = Encoded(self.vocabulary, texts)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, data.owner, self.window_logits(data))
        return best

    def score(self, texts: list[list[str]]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        a, b = self.scale
        return 1.0 / (1.0 + np.exp(-np.clip(a * self.text_logits(texts) + b, -50, 50)))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def train(cut: list[str], owner: np.ndarray, labels: np.ndarray, prior: float, steps: int = 500,
          batch: int = 256, min_docs: int = 6, max_words: int = 20_000, seed: int = 11) -> Network:
    """Train on windows ``cut`` (of at most WIDTH words) of the documents
    ``owner``, which come one after the other, with their ``labels``; ``prior`` is the share of label 1 among all
    labelled documents, which the classes are weighted to.

    A document's label holds for its highest window, as that decides its score.
    The first steps take any window with its document's label; from then on, a
    label 1 is learned from the highest window of a document alone, and a label
    0 from the highest windows and from any others by turns.
    """
    rng = np.random.default_rng(seed)
    df: Counter[str] = Counter()
    for _, own in groupby(zip(owner.tolist(), cut), key=lambda x: x[0]):
        df.update({normal_form(w) for _, t in own for w in t.split()})
    common = sorted(((n, f) for f, n in df.items() if n >= min_docs), key=lambda x: (-x[0], x[1]))[:max_words]
    del df
    net = Network({f: k + 1 for k, (_, f) in enumerate(common)}, start_weights(len(common) + 1, rng))
    if not cut or len(set(labels.tolist())) < 2:
        net.scale = (0.0, float(np.log((prior + 1e-3) / (1 - prior + 1e-3))))
        return net
    data = Encoded(net.vocabulary, (t.split() for t in cut))
    # One document in five calibrates the score; the network doesn't learn from it.
    apart = rng.random(len(labels)) < 0.2
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart[:] = False
    y = labels[owner]
    learn = ~apart[owner]
    pos, neg = np.flatnonzero(learn & (y == 1)), np.flatnonzero(learn & (y == 0))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    half, first, top = batch // 2, steps // 4, None
    for step in range(steps):
        if step >= first and (step - first) % max(1, steps // 7) == 0:
            top = highest(net.window_logits(data), owner)
            high_pos, high_neg = (top[learn[top] & (y[top] == c)] for c in (1, 0))
        ones = pos if top is None else high_pos
        zeros = neg if top is None or step % 2 else high_neg
        pick = np.concatenate([rng.choice(ones, half), rng.choice(zeros, batch - half)])
        _, g = gradients(net.weights, *data.subset(pick), y[pick].astype(np.float32), np.full(batch, 1.0 / batch, np.float32))
        rate = 0.02 * (1.0 if step < steps * 0.6 else 0.3 if step < steps * 0.85 else 0.1)
        for k, v in g.items():
            m, s2 = moments[k]
            m += 0.1 * (v - m)
            s2 += 0.01 * (v * v - s2)
            fix = np.sqrt(1 - 0.99 ** (step + 1)) / (1 - 0.9 ** (step + 1))
            decay = 1 - rate * (0.05 if k in ("words", "chars") else 0.002)
            net.weights[k] = (decay * net.weights[k] - rate * fix * m / (np.sqrt(s2) + 1e-6)).astype(np.float32)
    # Calibration of a document's highest logit: logistic, weighted to the prior.
    s = net.window_logits(data)
    at = highest(s, owner)
    at = at[apart[owner[at]]] if apart.any() else at
    net.scale = logistic(s[at], y[at], prior)
    return net


def highest(score: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The row with the highest score of each owner."""
    order = np.lexsort((score, owner))
    return order[np.append(np.diff(owner[order]) > 0, True)]


def logistic(t: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset of P(1 | t), the classes weighing as in ``prior``."""
    weight = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum()))
    mean, spread = float(t.mean()), float(t.std()) + 1e-6
    z, a, b = (t - mean) / spread, 1.0, 0.0
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * z + b, -30, 30)))
        e, v = weight * (p - y), weight * p * (1 - p)
        hess = np.array([[(v * z * z).sum() + 1e-4, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-4]])
        da, db = np.linalg.solve(hess, [(e * z).sum() + 1e-4 * (a - 1), e.sum()])
        a, b = a - float(np.clip(da, -1, 1)), b - float(np.clip(db, -1, 1))
    a = max(a, 0.05)
    return a / spread, b - a * mean / spread


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = 1500, windows_per_text: int = 64,
        mod: int = 3, rest: int = 1, **training) -> Network:
    """Fit on at most ``per_class`` documents of each label outside the
    held-out fold, and of each at most ``windows_per_text`` windows spread
    over the whole text. Conflicting labels of a document: the larger."""
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("doc_id is not null and label in (0, 1)").where(~is_held_out(F.col("doc_id"), mod, rest))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    share = marks.agg(F.avg("label")).first()[0]
    picked = bounded_sample(marks, "label", per_class, F.xxhash64("doc_id"))

    def spread(batches):
        for part in slices(batches):
            key, label, out = [], [], []
            for i, text, y in zip(*(named(part, c).to_pylist() for c in ("doc_id", "text", "label"))):
                words = words_of(text)
                spans = windows(len(words))
                every = -(-len(spans) // windows_per_text)
                for s, n in spans[i % every::every]:
                    key.append(i), label.append(y), out.append(" ".join(words[s:s + n]))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(label, pa.int32()), pa.array(out, pa.string())], ["doc_id", "label", "words"])

    # The sample has at most 2 * per_class rows: a bounded broadcast.
    found = (id_text(docs, id_col, text_col).join(F.broadcast(picked), "doc_id")
             .mapInArrow(spread, "doc_id long, label int, words string").toArrow())
    rows = sorted(zip(*(found[c].to_pylist() for c in ("doc_id", "label", "words"))))
    number = {i: k for k, i in enumerate(dict.fromkeys(r[0] for r in rows))}
    label = {number[r[0]]: float(r[1]) for r in rows}
    return train([r[2] for r in rows], np.array([number[r[0]] for r in rows], np.int64),
                 np.array([label[k] for k in range(len(label))]), float(share or 0.0), **training)


def score_toxicity(docs: DataFrame, labels: DataFrame, network: Network | None = None,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   threshold: float = 0.7, mod: int = 3, rest: int = 1, **fitting) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    ``network`` defaults to :func:`fit` on the labelled documents outside the
    held-out fold. All windows of the whole text are scored; the document's
    score is that of its highest window. A null, empty or blank text is one
    window without a word and gets the network's score of that. Without
    labels of both classes every score is the share of label 1 (0 without
    any). Repeated rows score alike and are all returned; a null id matches no
    label and is not held out. Other columns are ignored.
    """
    net = network or fit(docs, labels, id_col, text_col, label_col, mod=mod, rest=rest, **fitting)

    def score(batches):
        for part in slices(batches, 1 << 20):
            s = net.score([words_of(t) for t in named(part, "text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [named(part, "doc_id"), named(part, "held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = id_text(docs, id_col, text_col).withColumn("held_out", is_held_out(F.col("doc_id"), mod, rest))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
