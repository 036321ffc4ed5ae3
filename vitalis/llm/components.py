"""Connected components and verified links inside candidate groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import drop_table, write_table


def _stars(edges: DataFrame) -> bool:
    """Whether every left node has one edge and no right node is a left one."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("l"), F.lit(0).alias("r")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    bad = ends.groupBy("n").agg(F.sum("l").alias("l"), F.max("r").alias("r")).where("l > 1 or (l = 1 and r = 1)")
    return bad.limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the edges ``a, b``: ``comp`` is the
    smallest node that is connected with it.

    Alternating large and small stars: each round joins every node to the
    least one that its neighbours know, until all components are stars. All
    steps are aggregations with partial minima and joins to one row per node.
    These rows are written before they are joined: both sides are then plain
    exchanges, and Spark can split a hub's edges over several tasks. Each round
    is a written table; those of the round before are removed.
    """
    now = write_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = write_table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = write_table(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        drop_table(now), drop_table(low)
        low = write_table(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        now = write_table(small.where("a <> b"), "small-star")
        drop_table(large), drop_table(low)
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
        now.select(F.col("b"), F.col("b")).distinct())


class Joined:
    """Union-find with the members of each set."""

    def __init__(self, n: int):
        self.root = list(range(n))
        self.members: dict[int, list[int]] = {}

    def add(self, k: int) -> None:
        self.members[k] = [k]

    def join(self, a: int, b: int) -> None:
        a, b = self.root[a], self.root[b]
        if a != b:
            if len(self.members[a]) < len(self.members[b]):
                a, b = b, a
            for k in self.members[b]:
                self.root[k] = a
            self.members[a] += self.members.pop(b)


def spanning_links(n: int, allowed: Callable[[int, int], bool], similar: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
    """Links that connect what all similar pairs of ``n`` items would connect.
    A pair that is connected already isn't compared, so a cluster costs about
    one comparison an item; unconnected pairs are all compared."""
    sets = Joined(n)
    for y in range(n):
        sets.add(y)
        for root in [r for r in sets.members if r != y]:
            if sets.root[root] == sets.root[y]:
                continue
            for x in list(sets.members[sets.root[root]]):
                if x != y and allowed(x, y) and similar(x, y):
                    sets.join(x, y)
                    yield x, y
                    break


def verified_links(members: DataFrame, prepare: Callable[[dict], object],
                   similar: Callable[[object, object], bool], block: int = 256) -> DataFrame:
    """``a, b``: enough verified pairs to connect every group as all of them would.

    ``members`` has ``node``, ``comp`` (the candidate group) and whatever
    ``prepare`` reads to make the item that ``similar`` compares. A group of
    more than ``block`` members is cut into chunks by a hash of the node, and
    each pair of chunks is a task of its own of two chunks at most; so no group
    gathers in one place, and no pair is left out.
    """
    sizes = (members.groupBy("comp").agg(F.count("*").alias("n")).where("n > 1")
             .select("comp", F.ceil(F.col("n") / block).alias("chunks")))
    kind = members.schema["node"].dataType
    names = [c for c in members.columns if c != "comp"]
    pairs = (members.join(sizes, "comp")
             .withColumn("c", F.pmod(F.xxhash64("node", F.lit(5)), F.col("chunks")))
             .withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .select("comp", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", *names))
    dealt = pairs.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "node")

    def links(rows: list[dict], out: tuple[list, list]) -> None:
        if len(rows) < 2:
            return
        items = [prepare(r) for r in rows]
        chunk = [r["c"] for r in rows]
        across = rows[0]["i"] != rows[0]["j"]
        allowed = (lambda x, y: chunk[x] != chunk[y]) if across else (lambda x, y: True)
        for x, y in spanning_links(len(rows), allowed, lambda x, y: similar(items[x], items[y])):
            if rows[x]["node"] != rows[y]["node"]:
                out[0].append(rows[x]["node"])
                out[1].append(rows[y]["node"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key = None
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for row in batch.to_pylist():
                now = (row["comp"], row["i"], row["j"])
                if now != key:
                    links(held, out)
                    held, key = [], now
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field("node").type), pa.array(out[1], batch.schema.field("node").type)], ["a", "b"])
        out = ([], [])
        links(held, out)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field("node").type), pa.array(out[1], batch.schema.field("node").type)], ["a", "b"])

    return dealt.mapInArrow(run, f"a {kind.simpleString()}, b {kind.simpleString()}")
