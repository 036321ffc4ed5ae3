"""SimHash near-duplicate documents with vantage-point trees.

A fingerprint has the majority bits of the hashes of a document's word
shingles. Two fingerprints within a radius of 4 bits are linked. As distances
of unrelated fingerprints gather at 32 of 64 bits, a tree over all bits would
visit both sides of nearly every split at that radius; but of three parts of
the bits, one differs in at most a third of the radius. So there is one tree for
each part: its nodes split by the Hamming distance of that part to a vantage
point, and a ball of radius 1 seldom meets both sides.

The top of the trees, made from a sample, deals the fingerprints to shards; a
fingerprint is stored in its own shard and asked in the others that its ball
meets. Below, each shard goes on with trees of its own and checks the distance
over all bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import id_text, named, slices, write_table
from vitalis.llm.components import connected_components

BITS = 64
BITS_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1
#: Pairs compared at a time at the bottom of a tree.
LEAF = 1 << 16


# -- fingerprints


def shingle_hashes(text: str, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``width`` words of the lower-cased text, joined by
    blanks, repeats included, in arrays of bounded size; a shorter text is one
    run, and one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    width = min(width, len(words))
    line = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    end = (begin + sizes)[width - 1:].tolist()
    begin = begin[:len(end)].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(end), LEAF):
        a, b = begin[at:at + LEAF], end[at:at + LEAF]
        yield np.fromiter((digest(line[i:j], seed) for i, j in zip(a, b)), np.uint64, len(a))


def fingerprint(text: str, width: int = 4, seed: int = 42) -> int:
    """Bit k is set if it is in more than half of the hashes."""
    ones, n = np.zeros((8, 8), np.int64), 0
    for h in shingle_hashes(text, width, seed):
        lanes = h.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[k] += np.bincount(lanes[:, k], minlength=256) @ BITS_OF_BYTE
        n += len(h)
    return int(np.packbits(2 * ones.ravel() > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fp = np.array([fingerprint(t, width, seed) for t in named(part, "text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([named(part, "doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
    return run


# -- trees


def parts(radius: int) -> list[tuple[np.uint64, int]]:
    """Masks of disjoint bits and a radius for each: whoever differs in at most
    ``radius`` bits is within that of one mask."""
    n = 3
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(np.uint64(((1 << (b - a)) - 1) << a), radius // n) for a, b in zip(cuts, cuts[1:])]


def split_at(distance: np.ndarray) -> int | None:
    """A radius that halves the distances as well as it can; none if they are all equal."""
    low, high = int(distance.min()), int(distance.max())
    return None if low == high else min(max(int(np.median(distance)), low), high - 1)


class ShardTree:
    """The top of a tree: vantage points and radii from a sample, by levels."""

    def __init__(self, sample: np.ndarray, mask: np.uint64, radius: int, shards: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mask, self.radius, self.shards = mask, radius, 0
        self.vantage, self.inner, self.children, self.leaf = [], [], [], []
        todo = [(sample & mask, self._node(), max(1, shards))]
        for points, node, want in todo:  # grows while it is read
            mu = None
            if want > 1 and len(points) > 1:
                v = points[rng.integers(len(points))]
                d = np.bitwise_count(points ^ v)
                mu = split_at(d)
            if mu is None:
                self.leaf[node], self.shards = self.shards, self.shards + 1
                continue
            near = d <= mu
            left, right = self._node(), self._node()
            self.vantage[node], self.inner[node], self.children[node] = v, mu, (left, right)
            todo += [(points[near], left, want // 2), (points[~near], right, want - want // 2)]
        self.vantage, self.inner = np.array(self.vantage, np.uint64), np.array(self.inner, np.int64)
        self.children, self.leaf = np.array(self.children, np.int64), np.array(self.leaf, np.int64)

    def _node(self) -> int:
        self.vantage.append(0), self.inner.append(-1), self.children.append((-1, -1)), self.leaf.append(-1)
        return len(self.leaf) - 1

    def home(self, x: np.ndarray) -> np.ndarray:
        """The shard that stores each fingerprint."""
        return self._descend(x, 0)[1]

    def met(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and shards: all shards that the triangle bounds leave for a
        ball around each fingerprint."""
        return self._descend(x, self.radius)

    def _descend(self, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        x = x & self.mask
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        rows, shards = [], []
        while len(row):
            done = self.leaf[node] >= 0
            rows.append(row[done]), shards.append(self.leaf[node[done]])
            row, node = row[~done], node[~done]
            d = np.bitwise_count(x[row] ^ self.vantage[node]).astype(np.int64)
            # A point within the radius of x is at d - radius from the vantage point at least, d + radius at most.
            left, right = d - radius <= self.inner[node], d + radius > self.inner[node]
            row, node = np.r_[row[left], row[right]], np.r_[self.children[node[left], 0], self.children[node[right], 1]]
        row, shard = np.concatenate(rows), np.concatenate(shards)
        order = np.lexsort((shard, row))
        return row[order], shard[order]


class LocalLinks:
    """Links among the fingerprints of one shard, and from others to them.

    ``label`` names the connected set of each stored fingerprint; only links
    that join two sets are given out, so a dense group costs a link a member.
    """

    def __init__(self, stored: np.ndarray, mask: np.uint64, radius: int, part_radius: int):
        self.x, self.mask, self.radius, self.part_radius = stored, mask, radius, part_radius
        self.label = np.arange(len(stored))
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.compared = 0

    def _join(self, a: int, others: np.ndarray) -> None:
        """Link ``a`` with one of each other set among ``others``."""
        sets, first = np.unique(self.label[others], return_index=True)
        new = sets != self.label[a]
        if new.any():
            ends = others[first[new]]
            self.links.append((np.full(len(ends), self.x[a]), self.x[ends]))
            if len(ends) == 1:
                self.label[self.label == sets[new][0]] = self.label[a]
            else:
                self.label[np.isin(self.label, sets[new])] = self.label[a]

    def inside(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Links that connect the stored fingerprints as all their pairs would."""
        def found(e: np.ndarray, q: np.ndarray) -> None:
            for a in np.unique(e).tolist():
                self._join(a, q[e == a])
        rows = np.arange(len(self.x))
        self._search(rows, self.x, rows, found, lambda v, near: self._join(v, near))
        out, self.links = self.links, []
        return out

    def outside(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """One link from each query to each set that it is linked with."""
        pairs: list[tuple[np.ndarray, np.ndarray]] = []

        def once(q: np.ndarray, e: np.ndarray) -> None:
            _, first = np.unique(np.stack((q, self.label[e])), axis=1, return_index=True)
            pairs.append((q[first], e[first]))
        self._search(np.arange(len(self.x)), queries, np.arange(len(queries)), lambda e, q: once(q, e),
                     lambda v, near: pairs.append((near, np.full(len(near), v))))
        if not pairs:
            return []
        found, pairs = [np.concatenate(c) for c in zip(*pairs)], []
        once(*found)
        q, e = pairs[0]
        return [(queries[q], self.x[e])]

    def _search(self, stored: np.ndarray, queries: np.ndarray, asked: np.ndarray, found, star) -> None:
        """Give ``found`` the linked rows of stored and asked that no vantage
        point connects; ``star`` gets each vantage point with the asked that
        are linked with it."""
        todo = [(stored, asked)]
        while todo:
            e, q = todo.pop()
            if not len(e) or not len(q):
                continue
            if len(e) * len(q) <= LEAF:
                self._compare(e, q, queries, found)
                continue
            v = e[len(e) // 2]
            full_e, full_q = (np.bitwise_count(p ^ self.x[v]) for p in (self.x[e], queries[q]))
            self.compared += len(e) + len(q)
            near_e, near_q = full_e <= self.radius, full_q <= self.radius
            if near_q.any():
                star(v, q[near_q])
            # Two that are linked with the vantage point are connected: only stored ones near
            # it against asked ones just beyond, and the other stored ones, are left.
            beyond = ~near_q & (full_q <= 2 * self.radius)
            if near_e.any():
                todo.append((e[near_e & (e != v)], q[beyond]))
            e, full_e = e[~near_e], full_e[~near_e]
            if not len(e):
                continue
            for d_e, d_q, radius in ((np.bitwise_count((self.x[e] ^ self.x[v]) & self.mask), np.bitwise_count((queries[q] ^ self.x[v]) & self.mask), self.part_radius),
                                     (full_e, full_q, self.radius)):
                mu = split_at(d_e)
                if mu is not None:
                    near, d_q = d_e <= mu, d_q.astype(np.int64)
                    todo += [(e[near], q[d_q - radius <= mu]), (e[~near], q[d_q + radius > mu])]
                    break
            else:
                for at in range(0, len(e), 256):
                    self._compare(e[at:at + 256], q, queries, found)

    def _compare(self, e: np.ndarray, q: np.ndarray, queries: np.ndarray, found) -> None:
        step = max(1, LEAF // len(e))
        for at in range(0, len(q), step):
            some = q[at:at + step]
            i, j = np.nonzero(np.bitwise_count(self.x[e][:, None] ^ queries[some][None, :]) <= self.radius)
            self.compared += len(e) * len(some)
            if len(i):
                found(e[i], some[j])


# -- shards


def _deal(trees: list[ShardTree], chunks: dict[tuple[int, int], int], homes_only: bool = False):
    """Rows of each fingerprint: one where it is stored, and one for each
    chunk of stored ones that it must be asked in. Of two shards, the one
    with the smaller number is asked, and so of two chunks of one shard."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = named(b, "fp").to_numpy().view(np.uint64)
            for t, tree in enumerate(trees):
                home = tree.home(fp)
                if homes_only:
                    shard, rows = np.unique(home, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(shard), t, np.int32)), pa.array(shard), pa.array(rows)], ["tree", "shard", "rows"])
                    continue
                count = np.ones(tree.shards, np.int64)
                for (at, shard), n in chunks.items():
                    if at == t:
                        count[shard] = n
                own = ((fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % count[home]
                row, shard = tree.met(fp)
                row, shard = row[shard <= home[row]], shard[shard <= home[row]]
                asked = np.where(shard == home[row], own[row], count[shard])  # chunks before its own, or all
                row, shard, first = np.repeat(row, asked), np.repeat(shard, asked), np.repeat(np.cumsum(asked) - asked, asked)
                chunk = np.arange(len(row)) - first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp) + len(row), t, np.int32)), pa.array(np.r_[home, shard].astype(np.int32)),
                     pa.array(np.r_[own, chunk].astype(np.int32)), pa.array(np.r_[np.zeros(len(fp), bool), np.ones(len(row), bool)]),
                     pa.array(np.r_[fp, fp[row]].view(np.int64))], ["tree", "shard", "chunk", "asked", "fp"])
    return run


def _link(masks: list[tuple[np.uint64, int]], radius: int):
    """Links of each chunk; its stored fingerprints come first, then the
    asked ones, which are searched batch by batch."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, local = None, [], None

        def opened() -> tuple[LocalLinks, list]:
            mask, part_radius = masks[key[0]]
            made = LocalLinks(np.concatenate(held) if held else np.zeros(0, np.uint64), mask, radius, part_radius)
            return made, made.inside()

        def batch_of(links: list) -> pa.RecordBatch:
            a, b = (np.concatenate(c).view(np.int64) for c in zip(*links)) if links else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for b in batches:
            tree, shard, chunk = (named(b, c).to_numpy() for c in ("tree", "shard", "chunk"))
            asked, fp = named(b, "asked").to_numpy(zero_copy_only=False), named(b, "fp").to_numpy().view(np.uint64)
            new = np.flatnonzero((np.diff(tree) != 0) | (np.diff(shard) != 0) | (np.diff(chunk) != 0) | (np.diff(asked.astype(np.int8)) != 0)) + 1
            out: list = []
            for rows in np.split(np.arange(len(fp)), new):
                if not len(rows):
                    continue
                now = (int(tree[rows[0]]), int(shard[rows[0]]), int(chunk[rows[0]]))
                if now != key:
                    if key is not None and local is None:
                        out += opened()[1]
                    key, held, local = now, [], None
                if not asked[rows[0]]:
                    held.append(fp[rows].copy())
                else:
                    if local is None:
                        local, links = opened()
                        out += links
                    out += local.outside(fp[rows])
            yield batch_of(out)
        if key is not None and local is None:
            yield batch_of(opened()[1])
    return run


def fingerprint_links(fingerprints: DataFrame, radius: int = 4, shard_rows: int = 16_384, sample: int = 1_000_000,
                      per_leaf: int = 32) -> DataFrame:
    """``a, b`` (long): enough pairs of the distinct ``fp`` that differ in at most
    ``radius`` bits to connect them as all such pairs would.

    The trees' tops come from ``per_leaf`` fingerprints (8 bytes each) for each shard of
    about ``shard_rows``, chosen by a hash, about ``sample`` (and 1,000) at most. A shard with more than four times
    as many, as of fingerprints that agree in a part, is cut into chunks by a
    hash, and what is asked in it goes to each chunk.
    """
    n = fingerprints.count()
    shards = max(1, min(-(-n // shard_rows), sample // per_leaf))
    rate = min(1.0, (shards * per_leaf + 1000.0) / max(n, 1))
    chosen = F.xxhash64("fp", F.lit(12)).cast("double") / 2.0 ** 64 + 0.5 <= rate
    picked = np.sort(fingerprints.where(chosen).select("fp").toArrow()["fp"].to_numpy()).view(np.uint64)
    masks = parts(radius)
    trees = [ShardTree(picked, mask, r, shards, k) for k, (mask, r) in enumerate(masks)]
    big = 4 * shard_rows
    chunks = {(r["tree"], r["shard"]): -(-r["rows"] // shard_rows) for r in
              fingerprints.mapInArrow(_deal(trees, {}, homes_only=True), "tree int, shard long, rows long")
              .groupBy("tree", "shard").agg(F.sum("rows").alias("rows")).where(F.col("rows") > big).collect()}  # a row a shard at most
    dealt = fingerprints.mapInArrow(_deal(trees, chunks), "tree int, shard int, chunk int, asked boolean, fp long")
    return (dealt.repartition("tree", "shard", "chunk").sortWithinPartitions("tree", "shard", "chunk", "asked")
            .mapInArrow(_link(masks, radius), "a long, b long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4,
                       seed: int = 42, shard_rows: int = 16_384) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    The text is lower-cased (A-Z only) and cut into words at ASCII white
    space; its shingles are runs of ``width`` words, repeats included, and a
    shorter text is one shingle. A bit of ``fingerprint`` (16 hexadecimal
    digits) is 1 if it is set in more than half of their XXH64 hashes.
    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the
    smallest id that a document can reach, itself included.

    A null, empty or blank text has fingerprint zero, which links like any other.
    Whole texts are read whatever their length. Equal fingerprints are one
    node from the start, however many documents share them. Rows that repeat an
    id are each returned; a row with a null id is reached, but is nobody's
    smallest id (null if the component has no other). No documents: no rows.
    Other columns are ignored.
    """
    signed = write_table(id_text(docs, id_col, text_col).mapInArrow(_fingerprints(width, seed), "doc_id long, fp long"), "simhash")
    nodes = write_table(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    comps = connected_components(fingerprint_links(nodes.select("fp"), radius, shard_rows))
    classed = nodes.join(comps.select(F.col("node").alias("fp"), "comp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    least = classed.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_fp = write_table(classed.select("fp", "comp").join(least, "comp").select("fp", "component_id"), "simhash-classes")
    return (signed.join(of_fp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
