"""Mixing sources to target weights.

The words of each source form one stream, cut into blocks of a fixed length.
The mix is a row of slots, dealt to output shards; every shard draws its
number of slots from each source, the source's slots go through a pseudorandom
permutation of its blocks, pass after pass, and the blocks are joined by index.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.common import ASCII_SPACE, WORD, named, slices, write_table

#: Weights of the sources in order, repeating, and how often a source may be used.
WEIGHTS, MAX_PASSES = (5.0, 2.0, 1.0), 3.0
SLOT_SCHEMA = "shard long, sid int, idx long, epoch int"
_M = (1 << 64) - 1


def targets(sizes: list[float], weights: list[float], passes: float = MAX_PASSES) -> list[float]:
    """Words of each source: all sizes shared by weight, at most ``passes``
    times a source's size, the excess shared again among the others."""
    out, open_, left = [0.0] * len(sizes), [k for k, s in enumerate(sizes) if s > 0], float(sum(sizes))
    while open_ and left > 0:
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if weights[k] / total * left >= passes * sizes[k]]
        if not full:
            for k in open_:
                out[k] = weights[k] / total * left
            break
        for k in full:
            out[k] = passes * sizes[k]
            left -= out[k]
        open_ = [k for k in open_ if k not in full]
    return out


def shard_counts(shard: int, shards: int, shard_slots: int, slots: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source before this shard, and in it.

    The draw is multinomial given the sources' totals: halving the row of
    shards again and again, the slots of the left half are drawn without
    replacement from those of both. Each half has its own seed, so any shard
    finds its numbers alone, and all shards together use up the totals."""
    low, high, node = 0, shards, 1
    before, own = np.zeros_like(slots), slots.copy()
    total = int(slots.sum())
    while high - low > 1:
        mid = (low + high) // 2
        left = min(mid * shard_slots, total) - min(low * shard_slots, total)
        if own.sum() < 500_000_000:
            rng = np.random.default_rng((seed, node & _M, node >> 64))
            part = rng.multivariate_hypergeometric(own, left, method="marginals") if own.sum() else own
        else:  # beyond the generator's range: in proportion, which the draw is to within 1e-4
            share = np.floor(own * (left / own.sum())).astype(np.int64)
            short = left - int(share.sum())
            room = np.flatnonzero(share < own)[:short]
            share[room] += 1
            part = share
        if shard < mid:
            own, high, node = part, mid, 2 * node
        else:
            before, own, low, node = before + part, own - part, mid, 2 * node + 1
    return before, own


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of ``range(size)``: four Feistel rounds on
    the next even number of bits, repeated while a value is out of range."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for r in range(4):
            f = right + np.uint64(((key + r + 1) * 0x9E3779B97F4A7C15) & _M)
            f = (f ^ (f >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(31))) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= np.uint64(size)]
    return x.astype(np.int64)


def _sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        size = [len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in named(part, "text").to_pylist()]
        yield pa.RecordBatch.from_arrays([named(part, "row"), named(part, "doc_id"), named(part, "source"), pa.array(size, pa.int64())],
                                         ["row", "doc_id", "source", "size"])


class Plan:
    """Sources with their targets and blocks, and how slots are dealt."""

    def __init__(self, sources: list[tuple[str | None, int, int]], block_words: int, shard_slots: int, seed: int,
                 weights: tuple[float, ...] = WEIGHTS, passes: float = MAX_PASSES):
        ordered = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
        self.source, self.docs, self.size = ([s[k] for s in ordered] for k in (0, 2, 1))
        self.target = targets(self.size, [weights[k % len(weights)] for k in range(len(ordered))], passes)
        # A small source has shorter blocks: 64 of them at least, if it has the words.
        self.length = [max(1, min(block_words, s // 64)) for s in self.size]
        self.blocks = [-(-s // n) for s, n in zip(self.size, self.length)]
        self.slots = np.array([round(t / n) for t, n in zip(self.target, self.length)], np.int64)
        self.seed, self.shard_slots = seed, shard_slots
        self.shards = max(1, -(-int(self.slots.sum()) // shard_slots))

    def table(self, spark) -> DataFrame:
        rows = [(k, s, int(z), float(t), int(n), max(1, -(-int(d) // 4096)))
                for k, (s, z, t, n, d) in enumerate(zip(self.source, self.size, self.target, self.length, self.docs))]
        return spark.createDataFrame(rows, "sid int, name string, source_size long, target double, length long, groups long")

    def draws(self):
        """For each shard number, its slots as (source, block, pass)."""
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for shard in b.column(0).to_pylist():
                    before, own = shard_counts(shard, self.shards, self.shard_slots, self.slots, self.seed)
                    sid = np.repeat(np.arange(len(own)), own)
                    epoch, index = np.zeros(len(sid), np.int64), np.zeros(len(sid), np.int64)
                    at = 0
                    for k in np.flatnonzero(own).tolist():
                        slot = before[k] + np.arange(own[k])
                        e, i = slot // self.blocks[k], slot % self.blocks[k]
                        out = np.empty(len(i), np.int64)
                        for one in np.unique(e).tolist():
                            out[e == one] = permuted(i[e == one], self.blocks[k], self.seed * 1_000_003 + k * 1009 + one * 17)
                        epoch[at:at + own[k]], index[at:at + own[k]] = e, out
                        at += int(own[k])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sid), shard, np.int64)), pa.array(sid.astype(np.int32)), pa.array(index),
                                                      pa.array(epoch.astype(np.int32))], ["shard", "sid", "idx", "epoch"])
        return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = 32, shard_slots: int = 1 << 15, seed: int = 20, weights: tuple[float, ...] = WEIGHTS,
        passes: float = MAX_PASSES, max_sources: int = 100_000, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents with their places in their sources' streams, and the uses
    of blocks: ``row, doc_id, size, sid, start, source_size, target, length``
    and ``shard, sid, idx, epoch``.

    Documents lie in a source's stream in the order of a hash. Their places are
    running sums in two steps: over groups of about 4,096 documents, then
    inside each group, so a source with a third of all rows isn't one task.
    Sources (``max_sources`` at most, else an error) are listed on the driver.
    ``row_col`` names a unique long of the input; else rows are numbered here.
    """
    spark = docs.sparkSession
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col).cast("long")
    rows = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    sized = write_table(rows.mapInArrow(_sizes, "row long, doc_id long, source string, size long"), "mix-sizes")
    listed = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).limit(max_sources + 1).collect()
    if len(listed) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    plan = Plan([(r["source"], r["size"], r["docs"]) for r in listed], block_words, shard_slots, seed, weights, passes)
    sources = F.broadcast(plan.table(spark))  # max_sources rows at most
    order = F.xxhash64("doc_id", "size")
    placed = (sized.join(sources, sized["source"].eqNullSafe(sources["name"])).withColumn("h", order)
              .withColumn("grp", F.floor((F.col("h").cast("double") / 2.0 ** 64 + 0.5) * F.col("groups")).cast("long")))
    sums = placed.groupBy("sid", "grp").agg(F.sum("size").alias("s"))
    offsets = sums.select(F.col("sid").alias("o_sid"), F.col("grp").alias("o_grp"),
                          (F.sum("s").over(Window.partitionBy("sid").orderBy("grp")) - F.col("s")).alias("offset"))
    inside = Window.partitionBy("sid", "grp").orderBy("h", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumn("run", F.sum("size").over(inside) - F.col("size"))
    spans = (run.join(offsets, (run["sid"] == offsets["o_sid"]) & (run["grp"] == offsets["o_grp"]))
             .select("row", "doc_id", "size", "sid", (F.col("offset") + F.col("run")).alias("start"), "source_size", "target", "length"))
    draws = spark.range(plan.shards, numPartitions=max(1, min(plan.shards, spark.sparkContext.defaultParallelism * 4)))
    return spans, draws.mapInArrow(plan.draws(), SLOT_SCHEMA)


def pieces(spans: DataFrame) -> DataFrame:
    """``row, sid, idx, first, words``: the part of a document in each block."""
    block = F.explode(F.sequence(F.floor(F.col("start") / F.col("length")), F.floor((F.col("start") + F.col("size") - 1) / F.col("length"))))
    low = F.greatest(F.col("start"), F.col("idx") * F.col("length"))
    high = F.least(F.col("start") + F.col("size"), (F.col("idx") + 1) * F.col("length"))
    return (spans.where("size > 0").withColumn("idx", block)
            .select("row", "sid", "idx", (low - F.col("start")).alias("first"), (high - low).alias("words")))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document.

    ``size`` counts the words of the text (null: 0), ``target`` the words that
    the mix wants of the document's source, ``taken`` the words that it takes of
    the document, repeats counted. A source yields its target to within about
    one block, no document more than three times its size, and reruns agree.

    Null and empty texts have size 0 and nothing is taken of them. A null source
    is a source of its own, the last. Rows that repeat an id are places of their
    own in the stream and are all returned; those that tie in id, size and
    source are exchangeable. No documents: no rows. Other columns are ignored.
    """
    spans, slots = mix(docs, **options)
    spans = write_table(spans, "mix-spans")
    # Spark takes the slots for as few as the shards they come from, and would
    # broadcast what grows with the corpus.
    uses = slots.groupBy("sid", "idx").agg(F.count("*").alias("uses")).hint("merge")
    taken = (pieces(spans).join(uses, ["sid", "idx"]).groupBy("row")
             .agg(F.sum(F.col("words") * F.col("uses")).alias("taken")))
    return (spans.join(taken.hint("merge"), "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def _cut(columns: list[str], text_col: str):
    """The columns, with the words in its ranges left of each text, and the
    white space that follows them in the original."""
    word = re.compile(WORD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column=text_col):
            out = []
            for text, ranges in zip(named(part, text_col).to_pylist(), named(part, "__ranges").to_pylist()):
                spans = [(r["first"], r["first"] + r["words"]) for r in sorted(ranges, key=lambda r: r["first"])]
                merged: list[list[int]] = []
                for a, b in spans:
                    if merged and merged[-1][1] == a:
                        merged[-1][1] = b
                    else:
                        merged.append([a, b])
                starts = [m.start() for m in word.finditer(text)] + [len(text)]
                cut = [text[starts[a] if a else 0:starts[b]] for a, b in merged]
                if merged[-1][1] < len(starts) - 1:  # the text goes on
                    cut[-1] = cut[-1].rstrip(ASCII_SPACE)
                out.append("".join(cut))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == text_col else named(part, c) for c in columns], columns)
    return run


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: one row per document
    and pass in which the mix takes words of it, its text cut to the blocks that
    this pass uses (all of it, where it uses all). Nothing is taken of null and
    empty texts, so they give no row."""
    numbered = write_table(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-docs")
    spans, slots = mix(numbered, id_col, text_col, row_col="__row", **options)
    parts = (pieces(spans).join(slots.hint("merge"), ["sid", "idx"]).groupBy(F.col("row").alias("__of"), F.col("epoch").alias("__pass"))
             .agg(F.collect_list(F.struct("first", "words")).alias("__ranges")))
    picked = numbered.join(parts.hint("merge"), numbered["__row"] == parts["__of"]).select(*docs.columns, "__ranges")
    return picked.mapInArrow(_cut(docs.columns, text_col), docs.schema)
