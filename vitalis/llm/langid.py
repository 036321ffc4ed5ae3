"""Language identification in two levels.

A softmax classifier tells the language families apart; inside a family,
linear support vector machines separate each pair of its languages and vote.
Both read the relative frequencies of hashed character bigrams and trigrams
of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.common import bounded_sample, id_text, is_held_out, named, slices

#: Family of a language code. A code outside it is a family of
#: its own.
FAMILIES = {
    "af": "germanic", "da": "germanic", "de": "germanic", "en": "germanic", "is": "germanic",
    "nb": "germanic", "nl": "germanic", "nn": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "gl": "romance", "it": "romance",
    "oc": "romance", "pt": "romance", "ro": "romance",
    "be": "slavic", "bg": "slavic", "cs": "slavic", "hr": "slavic", "mk": "slavic",
    "pl": "slavic", "ru": "slavic", "sk": "slavic", "sl": "slavic", "sr": "slavic", "uk": "slavic",
}
UNKNOWN = "und"
BUCKETS = 1 << 13
#: Code points read at once of a long text.
PIECE = 1 << 20
_LETTER: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def grams(codes: np.ndarray) -> np.ndarray:
    """Buckets of the bigrams and trigrams of lower-cased code points, in which
    every run of other characters than letters is one blank."""
    keep = letters()[codes]
    x = np.where(keep, codes, 32)
    x = x[keep | np.append(True, keep[:-1])].astype(np.uint64) if len(x) else x.astype(np.uint64)
    if len(x) < 2:
        return np.zeros(0, np.int64)
    mix = lambda v: ((v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 13)
    two = x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * np.uint64(0x165667B19E3779F9) + x[2:] * np.uint64(0xD6E8FEB86659FD93)
    return np.concatenate([mix(two), mix(three)]).astype(np.int64)


def pieces(text: str) -> Iterator[np.ndarray]:
    """Gram buckets of a whole text, a bounded piece at a time; neighbouring
    pieces share two code points, so no trigram is lost."""
    low = text.lower()
    for at in range(0, max(1, len(low) - 2), PIECE):
        part = low[at:at + PIECE + 2].encode("utf-32-le", "surrogatepass")
        yield grams(np.frombuffer(part, np.uint32))


def frequencies(text: str) -> np.ndarray:
    total = np.zeros(BUCKETS)
    for g in pieces(text):
        total += np.bincount(g, minlength=BUCKETS)
    return total / max(1.0, total.sum())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _descend(loss_gradient, shape: tuple, steps: int = 150, rate: float = 0.5) -> np.ndarray:
    """Accelerated gradient descent from zero."""
    w = np.zeros(shape, np.float32)
    ahead, last = w, w
    for k in range(steps):
        new = ahead - rate * loss_gradient(ahead)
        ahead = new + (k / (k + 3.0)) * (new - last)
        last = new
    return last


class TwoLevel:
    """Fitted weights: families, then one machine per pair of languages."""

    def __init__(self, x: np.ndarray, y: list[str], families: dict[str, str], l2: float = 1e-3):
        self.langs = sorted(set(y))
        family = {c: families.get(c, c) for c in self.langs}
        self.families = sorted(set(family.values()))
        self.members = [[c for c in self.langs if family[c] == f] for f in self.families]
        mean = x.mean(0) if len(x) else np.zeros(BUCKETS)
        scale = (1.0 / np.sqrt(mean + 1e-5)).astype(np.float32)
        z = np.full((len(x), BUCKETS + 1), 0.3, np.float32)  # the last column is constant
        np.multiply(x, scale, out=z[:, :-1], casting="same_kind")
        size = float(np.einsum("ij,ij->", z[:, :-1], z[:, :-1]) / len(z)) if len(z) else 1.0
        scale = scale / np.float32(np.sqrt(size))  # rows of length one on average
        z[:, :-1] /= np.float32(np.sqrt(size))
        where = np.array(y, dtype=object)
        columns = []
        f_of = np.array([self.families.index(family[c]) for c in y], dtype=int)
        hot = np.eye(len(self.families), dtype=np.float32)[f_of] if len(y) else np.zeros((0, 0), np.float32)
        weight = (1.0 / np.maximum(hot.sum(0), 1))[f_of][:, None] / max(1, len(self.families)) if len(y) else 0

        def softmax_gradient(w):
            s = z @ w
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            return z.T @ ((p - hot) * weight) + l2 * 0.01 * w

        if len(self.families) > 1:
            columns.append(_descend(softmax_gradient, (z.shape[1], len(self.families)), rate=2.0))
        self.pairs, slopes = [], []
        for group in self.members:
            for a, b in combinations(group, 2):
                rows = (where == a) | (where == b)
                zz, t = z[rows], np.where(where[rows] == a, 1.0, -1.0).astype(np.float32)
                wt = np.where(t > 0, 0.5 / (t > 0).sum(), 0.5 / (t < 0).sum()).astype(np.float32)

                def hinge_gradient(w, zz=zz, t=t, wt=wt):
                    slack = np.maximum(0.0, 1.0 - t * (zz @ w))
                    return -2.0 * zz.T @ (wt * t * slack) + l2 * w

                w = _descend(hinge_gradient, (z.shape[1],), rate=0.4)
                margin = t * (zz @ w)
                slopes.append(4.0 / max(0.1, float(np.median(margin))))  # the median row scores about 0.98
                self.pairs.append((a, b))
                columns.append(w[:, None])
        table = np.concatenate(columns, 1) if columns else np.zeros((BUCKETS + 1, 0), np.float32)
        self.table = (table[:-1] * scale[:, None]).astype(np.float32)
        self.bias = 0.3 * table[-1]
        self.slopes = slopes

    def raw(self, text: str) -> np.ndarray:
        """Mean weight over all grams of the text, for each linear function."""
        total, n = np.zeros(self.table.shape[1]), 0
        for g in pieces(text):
            total += self.table[g].sum(0, dtype=np.float64)
            n += len(g)
        return total / max(1, n) + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        """Language and confidence; ``und`` and 0 without a letter or model."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        raw = self.raw(text)
        k = len(self.families) if len(self.families) > 1 else 0
        best, sure = 0, 1.0
        if k:
            p = np.exp(raw[:k] - raw[:k].max())
            p /= p.sum()
            best, sure = int(p.argmax()), float(p.max())
        group = self.members[best]
        votes = {c: [0, 0.0] for c in group}
        for j, (a, b) in enumerate(self.pairs):
            if a in votes:
                s = raw[k + j]
                votes[a if s >= 0 else b][0] += 1
                p = 1.0 / (1.0 + np.exp(-np.clip(self.slopes[j] * s, -50, 50)))
                votes[a][1] += p
                votes[b][1] += 1.0 - p
        winner = min(group, key=lambda c: (-votes[c][0], -votes[c][1], c))
        if len(group) > 1:
            sure *= votes[winner][1] / (len(group) - 1)
        return winner, float(min(1.0, max(0.0, sure)))


def _sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        lang, at, value = [], [], []
        for text, code in zip(named(part, "text").to_pylist(), named(part, "lang").to_pylist()):
            if has_letter(text):
                x = frequencies(text)
                hit = np.flatnonzero(x)
                lang.append(code), at.append(hit.astype(np.int32)), value.append(x[hit].astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
            ["lang", "at", "value"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 400, max_langs: int = 500, families: dict[str, str] | None = None,
        mod: int = 3, rest: int = 1) -> TwoLevel:
    """Fit on at most ``per_lang`` whole texts of each of the ``max_langs``
    most frequent languages outside the held-out fold. Only their gram
    frequencies (at most 8,192 numbers a text) reach the driver."""
    rows = id_text(docs, id_col, text_col, F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id"), mod, rest))
    picked = bounded_sample(rows, "lang", per_lang, F.xxhash64("doc_id"), max_langs)
    found = picked.select("text", "lang").mapInArrow(_sparse, "lang string, at array<int>, value array<float>").toArrow()
    rows = [(lang.as_py(), at.values.to_numpy(), value.values.to_numpy())
            for lang, at, value in zip(found["lang"], found["at"], found["value"])]
    rows.sort(key=lambda r: (r[0], float(r[1] @ r[2]), len(r[1])))  # the same order however the rows came
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for k, (_, at, value) in enumerate(rows):
        x[k, at] = value
    return TwoLevel(x, [r[0] for r in rows], FAMILIES if families is None else families)


def identify_language(docs: DataFrame, model: TwoLevel | None = None, id_col: str = "doc_id",
                      text_col: str = "text", lang_col: str = "lang", mod: int = 3, rest: int = 1,
                      **fitting) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document.

    ``model`` defaults to :func:`fit` on the documents themselves outside the
    held-out fold (crc32 of the id as text modulo ``mod`` equal to ``rest``).
    A null, empty or letterless text gives ``und`` with score 0, and so does
    any text when there was nothing to learn from. Long texts are read whole,
    in bounded pieces. A null id is not held out; repeated rows get equal
    predictions and are all returned. Other columns are ignored.
    """
    model = model or fit(docs, id_col, text_col, lang_col, mod=mod, rest=rest, **fitting)
    rows = id_text(docs, id_col, text_col).withColumn("held_out", is_held_out(F.col("doc_id"), mod, rest))
    return with_language(rows, model).drop("text")


def with_language(docs: DataFrame, model: TwoLevel, text_col: str = "text", pred_col: str = "lang_pred",
                  score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score as further columns;
    a null text reads as an empty one. No row moves to another task."""
    def predict(batches):
        for part in slices(batches, column=text_col):
            got = [model.predict(t or "") for t in named(part, text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*part.schema.names, pred_col, score_col])

    added = [T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())]
    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, *added]))
