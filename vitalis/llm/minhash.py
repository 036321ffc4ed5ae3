"""Near-duplicate documents by ProbMinHash.

A document is its five-word shingles, each weighing as often as it occurs.
Every shingle is a Poisson process whose rate is its weight; an arrival falls
on a random register, which keeps the shingle that arrives first. Two
signatures agree in a register with the probability Jaccard similarity of the
weights. Bands of registers give candidates, and candidates are verified by
the exact similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import id_text, named, slices, write_table
from vitalis.llm.components import connected_components, verified_links

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def shingle_hashes(words: list[bytes], width: int, known: dict[bytes, int]) -> np.ndarray:
    """Hash of every run of ``width`` words; a shorter text is one shingle.
    ``known`` keeps the hashes of words for other texts."""
    hashed = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        hashed.append(h)
    x = np.array(hashed, np.uint64)
    width = min(width, len(x))
    if not width:
        return x
    out = np.zeros(len(x) - width + 1, np.uint64)
    for k in range(width):
        out = _mix(out * _A + x[k:len(x) - width + 1 + k] + np.uint64(width))
    return out


def weights(words: list[bytes], width: int = 5, known: dict[bytes, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order of hash, and the share of each."""
    keys, counts = np.unique(shingle_hashes(words, width, {} if known is None else known), return_counts=True)
    return keys, counts / max(1, counts.sum())


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over shared d of 1 / sum over e of max(p_e / p_d, q_e / q_d)."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    p, q = a[1][ia], b[1][ib]
    order = np.argsort(q / p, kind="stable")
    p, q = p[order], q[order]
    only_p, only_q = max(0.0, 1.0 - p.sum()), max(0.0, 1.0 - q.sum())
    # e with q_e / p_e at most that of d counts p_e / p_d, the others q_e / q_d.
    below = np.cumsum(p)
    above = q.sum() - np.cumsum(q)
    return float((1.0 / ((below + only_p) / p + (above + only_q) / q)).sum())


def signatures(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash of ``n`` documents at once: element ``key`` of document
    ``owner`` with its weight. Round r holds the r-th arrival of each element;
    an element stops when it arrives later than all registers of its document
    are filled. A document without elements has zeros."""
    first = np.full(n * registers, np.inf)
    out = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(key))
    step = 0
    while len(key):
        step += 1
        r = _mix(key + np.uint64(step * int(_A) & ((1 << 64) - 1)))
        unit = ((r >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
        time = time - np.log(unit) / weight
        at = owner * registers + (_mix(r ^ _B) % np.uint64(registers)).astype(np.int64)
        hit = np.flatnonzero(time < first[at])
        hit = hit[np.argsort(-time[hit], kind="stable")]  # the earliest is written last
        first[at[hit]] = time[hit]
        out[at[hit]] = key[hit]
        alive = time < first.reshape(n, registers).max(1)[owner]
        owner, key, weight, time = owner[alive], key[alive], weight[alive], time[alive]
    return out.reshape(n, registers)


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each band of ``rows`` registers, documents by bands."""
    n, m = signature.shape
    parts = signature.reshape(n, m // rows, rows)
    h = np.broadcast_to(np.arange(1, m // rows + 1, dtype=np.uint64), (n, m // rows))
    for k in range(rows):
        h = _mix(h * _A + parts[:, :, k])
    return np.ascontiguousarray(h).view(np.int64)


def digest(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words)).digest()


def _sign(width: int, bands: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4 << 20):
            known: dict[bytes, int] = {}
            node, owner, keys, shares = [], [], [], []
            for k, (i, text) in enumerate(zip(named(part, "doc_id").to_pylist(), named(part, "text").to_pylist())):
                words = words_of(text)
                node.append(digest(words) if words and i is not None else None)
                if node[-1] is not None:
                    x, w = weights(words, width, known)
                    owner.append(np.full(len(x), k)), keys.append(x), shares.append(w)
            sig = signatures(*(np.concatenate(c) if c else np.zeros(0, t) for c, t in ((owner, np.int64), (keys, np.uint64), (shares, float))),
                             len(node), bands * rows)
            yield pa.RecordBatch.from_arrays(
                [named(part, "doc_id"), pa.array(node, pa.binary()), pa.array(list(band_hashes(sig, rows)), pa.list_(pa.int64()))],
                ["doc_id", "node", "bands"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    similarity: float = 0.8, bands: int = 24, rows: int = 5, block: int = 256) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` for every document.

    Documents are linked if their shingles have a probability Jaccard of
    ``similarity`` or more and agree in a band (at 0.8, 24 bands of 5 miss one
    pair in 14,000); classes are the connected components, ``class_id`` the
    smallest id in the class, and ``kept`` marks that document.

    Equal texts (same words in lower case) are one node from the start. Nodes
    with a common band hash are linked to the least of them; the components of
    these links are candidate groups, inside which all pairs with a common band
    that aren't connected yet are compared exactly, a bounded block at a time.

    A null, empty or blank text, and a row with a null id, is a class of its
    own. A text of fewer than ``width`` words is one shingle. Rows that repeat an
    id with the same text are one document (all marked alike); with different
    texts, each text is a node and the id is kept in the class whose smallest id
    it is. Whole texts are read whatever their length. No documents: no rows.
    Other columns are ignored.
    """
    texts = id_text(docs, id_col, text_col)
    signed = write_table(texts.mapInArrow(_sign(width, bands, rows), "doc_id long, node binary, bands array<long>"), "minhash")
    nodes = write_table(signed.where("node is not null").groupBy("node")
                        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "minhash-nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    # What is joined to many rows of a key is written first, as then Spark can
    # split the rows of a frequent key.
    least = write_table(keys.groupBy("key").agg(F.min("node").alias("m"), F.count("*").alias("n")).where("n > 1").select("key", "m"), "band-least")
    near = keys.join(least, "key").where("node <> m").select(F.col("node").alias("a"), F.col("m").alias("b")).distinct()
    groups = connected_components(near)
    needed = groups.join(nodes, "node").select("node", "comp", "rep", "bands")

    members = texts.join(needed, texts["doc_id"] == needed["rep"]).select("node", "comp", "bands", "text")

    def prepare(row: dict):
        words = words_of(row["text"])
        # A row that shares the id but not the text isn't this node.
        return (set(row["bands"]), weights(words, width)) if digest(words) == row["node"] else None

    def similar(x, y) -> bool:
        return x is not None and y is not None and not x[0].isdisjoint(y[0]) and probability_jaccard(x[1], y[1]) >= similarity

    links = verified_links(members, prepare, similar, block)
    final = connected_components(links)
    classed = nodes.select("node", "rep", "copies").join(final, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classes = classed.groupBy("comp").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    of_node = write_table(classed.select("node", "comp").join(classes, "comp").select("node", "class_id", "class_size"), "node-classes")
    return (signed.select("doc_id", "node").join(of_node, "node", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).alias("class_size"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))
