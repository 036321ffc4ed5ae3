"""Quality rules: an isolation forest on rule statistics.

Each text is reduced to rule statistics (counts, then ratios). Trees of
random splits, each grown on a small subsample, isolate unusual statistics
after few splits; the mean path length gives an anomaly score in (0, 1), and
the score above which a document is dropped is calibrated on labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.common import ASCII_SPACE, id_text, named, slices, write_table

#: Characters counted as symbols (fixed by the contract).
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the forest sees. Ratios to words or characters, drawn towards a
#: typical text by :data:`PRIOR` words, so that short clean texts look like long
#: ones; repetition is left to the base rules.
RATIOS = ("symbol_ratio", "symbol_words", "lone_symbols", "mean_word_chars", "punct_ratio",
          "run_ratio")
PRIOR, PRIOR_WORD_CHARS = 30, 6.0
STATS_SCHEMA = ("doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", "
                + ", ".join(f"{c} double" for c in RATIOS))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)
WINDOW = 5
_SPACE, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[list(ASCII_SPACE.encode())] = True
_SYMBOL[list(SYMBOLS.encode())] = True


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside some window of ``window`` words that occurs twice or more."""
    n = len(codes)
    if n <= window:
        return 0
    x = codes.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n - window + 1, np.uint64)
    for k in range(window):
        h += x[k:n - window + 1 + k] * _FACTORS[k % 5]
        h ^= h >> np.uint64(31)
        h *= _FACTORS[(k + 1) % 5]
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def statistics(text: str) -> tuple:
    """The five counts and the ratios of one whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    word_chars = len(text) - sum(text.count(c) for c in ASCII_SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    dup = len(lines) - len(set(lines))
    index: dict[bytes, int] = {}
    codes = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    repeat = repeated_words(codes)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(raw, minlength=256)
    punct = int(kinds[33:127].sum() - kinds[48:58].sum() - kinds[65:91].sum() - kinds[97:123].sum()) - symbols
    space, symbol = _SPACE[raw], _SYMBOL[raw]
    word_of = np.cumsum(~space & np.append(True, space[:-1])) - 1 if len(raw) else np.zeros(0, np.int64)
    with_symbol = int((np.bincount(word_of[symbol], minlength=n) > 0).sum())
    lone = n - int((np.bincount(word_of[~(space | symbol)], minlength=n) > 0).sum())
    same_next = int((codes[1:] == codes[:-1]).sum())
    m, c = n + PRIOR, word_chars + PRIOR * PRIOR_WORD_CHARS
    return (n, word_chars, symbols, dup, repeat, symbols / c, with_symbol / m, lone / m, c / m,
            punct / c, same_next / m)


def _stats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *BASE, *RATIOS]
    for part in slices(batches):
        rows = list(zip(*(statistics(t) for t in named(part, "text").to_pylist())))
        kinds = [pa.int64()] * len(BASE) + [pa.float64()] * len(RATIOS)
        yield pa.RecordBatch.from_arrays(
            [named(part, "doc_id"), *(pa.array(r, k) for r, k in zip(rows, kinds))], names)


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts and ratios per document."""
    return id_text(docs, id_col, text_col).mapInArrow(_stats, STATS_SCHEMA)


def _average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


def grow_tree(x: np.ndarray, rng: np.random.Generator, depth: int) -> list[tuple]:
    """One tree as rows (feature, cut, left, right, path); feature -1 at a leaf."""
    nodes: list[list] = []

    def grow(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, level + _average_path(len(rows))])
        low, high = rows.min(0), rows.max(0)
        wide = np.flatnonzero(high > low)
        if level < depth and len(rows) > 1 and len(wide):
            f = int(rng.choice(wide))
            cut = float(rng.uniform(low[f], high[f]))
            left = rows[:, f] < cut
            if left.any() and not left.all():
                nodes[at][:2] = f, cut
                nodes[at][2] = grow(rows[left], level + 1)
                nodes[at][3] = grow(rows[~left], level + 1)
        return at

    grow(x, 0)
    return [tuple(n) for n in nodes]


class Forest:
    """Isolation trees and the sample size that normalises their paths."""

    def __init__(self, sample: np.ndarray, trees: int = 100, rows: int = 256, seed: int = 7):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(sample))
        self.rows = max(1, min(rows, len(sample)))
        depth = max(1, math.ceil(math.log2(max(2, self.rows))))
        self.trees = []
        for k in range(trees if len(sample) else 0):
            at = (np.arange(self.rows) + k * self.rows) % len(sample)
            grown = grow_tree(sample[order[at]], rng, depth)
            self.trees.append(tuple(np.array(c) for c in zip(*grown)))
        self.depth = depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1]; 0.5 without any tree."""
        if not self.trees or not len(x):
            return np.full(len(x), 0.5)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, right, path in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                go = x[rows, np.maximum(f, 0)] < cut[node]
                node = np.where(f < 0, node, np.where(go, left[node], right[node]))
            total += path[node]
        return 2.0 ** (-(total / len(self.trees)) / max(_average_path(self.rows), 1e-9))


def base_failed(stats: DataFrame) -> DataFrame:
    return stats.withColumn("base_failed", (F.col("n_words") < 10)
                            | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def with_score(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with the forest's ``anomaly``."""
    names = stats.columns

    def score(batches):
        for b in batches:
            x = np.column_stack([named(b, c).to_numpy(zero_copy_only=False) for c in RATIOS]) if b.num_rows else np.zeros((0, len(RATIOS)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.score(x))], [*names, "anomaly"])

    return stats.mapInArrow(score, T.StructType([*stats.schema.fields, T.StructField("anomaly", T.DoubleType())]))


#: Cells of the score histogram that the calibration reads.
CELLS = 1000


def calibrate(histogram: list[tuple[int, int, int]], max_good_loss: float, default: float) -> float:
    """The cut from (cell, label, rows): the one with the fewest wrong rows,
    each class weighing one half, among the cuts that lose at most the share
    ``max_good_loss`` of the good rows. ``default`` if a class has no row."""
    good, bad = np.zeros(CELLS + 1), np.zeros(CELLS + 1)
    for cell, label, n in histogram:
        (good if label == 1 else bad)[min(max(int(cell), 0), CELLS)] += n
    if not good.sum() or not bad.sum():
        return default
    lost = np.append(np.cumsum(good[::-1])[::-1], 0) / good.sum()  # rows at or above a cell
    caught = np.append(np.cumsum(bad[::-1])[::-1], 0) / bad.sum()
    gain = np.where(lost <= max_good_loss, caught - lost, -1.0)
    return int(np.flatnonzero(gain == gain.max())[-1]) / CELLS


def isolation_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", label_col: str = "quality", trees: int = 100,
                      tree_rows: int = 256, max_good_loss: float = 0.02,
                      default_cut: float = 0.6) -> DataFrame:
    """Keep or drop every document by its rule statistics.

    Returns ``doc_id``, the counts of :data:`BASE`, ``base_failed`` (fewer
    than 10 words, or more than a fifth of them in repeated windows),
    ``anomaly`` (the forest's score), ``cut`` and ``kept`` (not base_failed
    and an anomaly under the cut).

    The forest is fitted on ``trees * tree_rows`` rows at most (each tree on
    its own ``tree_rows``), taken from all documents that pass the base rules
    by the order of a hash. The cut is calibrated on the score histogram of
    all labelled rows (:func:`calibrate`).

    A null or empty text has no words and fails the base rules. Repeated
    rows are scored alike and all returned; a null id matches no label. No
    labels, or labels of one class only: ``default_cut``. No documents: no
    rows. Other columns of the input are ignored.
    """
    stats = write_table(base_failed(rule_statistics(docs, id_col, text_col)), "quality-stats")
    passed, wanted = stats.where(~F.col("base_failed")), trees * tree_rows
    order = F.xxhash64("doc_id", *RATIOS)
    rate = min(1.0, (2.0 * wanted + 1000) / max(1, passed.count()))  # so that few rows are sorted
    sample = (passed.where(order.cast("double") / 2.0 ** 64 + 0.5 <= rate)
              .orderBy(order, "doc_id").limit(wanted).select(*RATIOS).collect())
    forest = Forest(np.array([tuple(r) for r in sample], dtype=float).reshape(-1, len(RATIOS)),
                    trees, tree_rows)
    scored = with_score(stats, forest)
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    histogram = (scored.where(~F.col("base_failed")).select("doc_id", F.floor(F.col("anomaly") * CELLS).alias("cell"))
                 .join(marks, "doc_id").groupBy("cell", "label").count().collect())
    cut = calibrate([tuple(r) for r in histogram], max_good_loss, default_cut)
    return (scored.withColumn("cut", F.lit(cut))
            .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.col("cut")))
            .select("doc_id", *BASE, "base_failed", "kept", "anomaly", "cut"))
