"""Ranked lexical search: MaxScore with bounds of term pairs.

Documents lie in shards. The index of a shard holds, for each term, its
postings with their impacts on the score, and their maxima by block of
documents; and for pairs of its frequent terms the documents that hold both,
with their joint maximum impacts. A pair's bound in a block is the joint maximum or
that of one term alone, which is less than the sum of both maxima wherever the
terms peak in different documents. A search combines a matching of the query's
pairs with its other terms, passes over blocks whose bound is under the
threshold, and in the others scores only the documents that a bound leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.common import id_text, named, slices, write_table

OUT_SCHEMA = "item_id long, rank int, doc_id long, score long"
#: Bytes as they count in a term: letters A-Z in lower case, ASCII letters, digits
#: and all bytes over 127 as they are, anything else a blank.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in their order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    """Of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a weight is multiplied with: documents of ``n`` terms that hold one ``tf`` times."""
    m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class ShardIndex:
    """Postings of a shard's documents, with maxima of terms and of pairs."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int,
                 k: int, pair_terms: int = 64, block: int = 64):
        self.ids, self.block, self.blocks = ids, block, -(-len(ids) // block)
        order = np.lexsort((doc, term))
        self.doc, self.impact, self.k = doc[order], impact[order], k
        self.ends = np.searchsorted(term[order], np.arange(n_terms + 1))
        size = np.diff(self.ends)
        self.max: dict[int, np.ndarray] = {}
        self.kth: dict[tuple[int, ...], int] = {}
        for t in np.flatnonzero(size).tolist():
            d, w = self.postings(t)
            self.max[t] = self._blockwise(d, w)
            self.kth[t,] = self._kth(w)
        # Pairs of the most frequent terms: their maxima are the loosest.
        frequent = np.argsort(-size, kind="stable")[:pair_terms]
        self.frequent = set(frequent[size[frequent] > 1].tolist())
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        self.saved: dict[tuple[int, int], int] = {}

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[t], self.ends[t + 1]
        return self.doc[a:b], self.impact[a:b]

    def _blockwise(self, doc: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.blocks, np.int64)
        np.maximum.at(out, doc // self.block, w)
        return out

    def _kth(self, w: np.ndarray) -> int:
        """Of ``k`` documents at least this much is certain."""
        return int(np.partition(w, len(w) - self.k)[len(w) - self.k]) if len(w) >= self.k else 0

    def intersect(self, wanted: Iterable[tuple[int, int]]) -> None:
        """The intersection lists of the wanted pairs (each of two frequent
        terms), as joint maxima by block: a block is in the list if it's not zero."""
        by_first: dict[int, list[int]] = {}
        for a, b in wanted:
            if a in self.frequent and b in self.frequent:
                by_first.setdefault(a, []).append(b)
        full = np.zeros(len(self.ids), np.int64)
        for a, others in by_first.items():
            d, w = self.postings(a)
            full[d] = w
            for b in others:
                e, v = self.postings(b)
                both = full[e] > 0
                joint = full[e[both]] + v[both]
                self.pairs[a, b] = self._blockwise(e[both], joint)
                self.kth[a, b] = self._kth(joint)
                self.saved[a, b] = int((self.max[a] + self.max[b] - self.pair_bound(a, b)).sum())
            full[d] = 0

    def pair_bound(self, a: int, b: int) -> np.ndarray:
        """Most that the two terms add to a document, by block."""
        return np.maximum(self.pairs[min(a, b), max(a, b)], np.maximum(self.max[a], self.max[b]))

    def matching(self, terms: list[int]) -> dict[int, int]:
        """Partners among the terms, greedily by what their pair saves."""
        gains = [(-self.saved[p], *p) for p in combinations(sorted(terms), 2) if self.saved.get(p)]
        partner: dict[int, int] = {}
        for _, a, b in sorted(gains):
            if a not in partner and b not in partner:
                partner[a], partner[b] = b, a
        return partner

    def bounds(self, terms: list[int], pairs: bool = True) -> np.ndarray:
        """Row j: most that the terms from the j-th on add to a document, by
        block. A pair counts as such where both its terms are left."""
        partner = self.matching(terms) if pairs else {}
        out, after = np.zeros((len(terms) + 1, self.blocks), np.int64), set()
        for j in range(len(terms) - 1, -1, -1):
            t = terms[j]
            other = partner.get(t)
            out[j] = out[j + 1] + (self.pair_bound(t, other) - self.max[other] if other in after else self.max[t])
            after.add(t)
        return out

    def search(self, terms: list[int], best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` best of this shard and of ``best`` (scores, ids), and how
        many documents were scored."""
        terms = [t for t in terms if t in self.max]
        if not terms:
            return *best, 0
        terms.sort(key=lambda t: (-int(self.max[t].max()), t))
        threshold = max([int(best[0][-1]) if len(best[0]) == self.k else 0] +
                        [self.kth.get(p, 0) for p in [(t,) for t in terms] + list(combinations(sorted(terms), 2))])
        # Blocks that can hold a document of the threshold or more; equal ones can win by their id.
        rest = self.bounds(terms)
        open_blocks = rest[0] >= max(threshold, 1)
        score, seen, essential = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool), True
        for at, t in enumerate(terms):
            d, w = self.postings(t)
            if essential:
                # A document that holds none of the terms so far reaches the bound of the others at most.
                new = open_blocks & (rest[at] >= max(threshold, 1))
                essential = bool(new.any())
                live = new[d // self.block] | seen[d]
                seen[d[live]] = True
            else:
                live = seen[d]
            score[d[live]] += w[live]
            if at + 1 < len(terms):
                some = np.flatnonzero(seen)
                if len(some) > self.k:
                    threshold = max(threshold, self._kth(score[some]))
                    seen[some[score[some] + rest[at + 1][some // self.block] < threshold]] = False
        some = np.flatnonzero(seen)
        some = some[score[some] > 0]
        scores, ids = np.r_[best[0], score[some]], np.r_[best[1], self.ids[some]]
        first = np.lexsort((ids, -scores))[:self.k]
        return scores[first], ids[first], len(some)


def _count(vocabulary: dict[bytes, int]):
    """Per document its number of terms, and how often it holds which of the vocabulary."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n, terms, counts = [], [], []
            for text in named(part, "text").to_pylist():
                words = terms_of(text)
                held: dict[int, int] = {}
                for t in map(vocabulary.get, words):
                    if t is not None:
                        held[t] = held.get(t, 0) + 1
                n.append(len(words)), terms.append(list(held)), counts.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [named(part, "doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "counts"])
    return run


def _search(queries: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int, shard_rows: int):
    """The best of each query among a task's documents, shard by shard; the
    threshold is carried on from one shard to the next."""
    wanted = sorted({p for q in queries for p in combinations(sorted(q), 2)})

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            while rows + b.num_rows >= shard_rows:
                yield pa.Table.from_batches([*held, b.slice(0, shard_rows - rows)]).combine_chunks()
                b, held, rows = b.slice(shard_rows - rows), [], 0
            held.append(b)
            rows += b.num_rows
        if rows:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for table in shards(batches):
            ids = table["doc_id"].to_numpy()
            lists = [table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c] for c in ("terms", "counts")]
            term, tf = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            doc = np.repeat(np.arange(len(ids)), lists[0].value_lengths().to_numpy())
            impact = weights[term] * impacts(tf, table["n"].to_numpy()[doc], n_docs, n_terms)
            index = ShardIndex(ids, doc, term, impact, len(weights), k)
            index.intersect(wanted)
            for q, terms in enumerate(queries):
                best[q] = index.search(terms, best[q])[:2]
        number = np.repeat(np.arange(len(queries), dtype=np.int32), [len(b[0]) for b in best])
        yield pa.RecordBatch.from_arrays([pa.array(number), *(pa.array(np.concatenate([b[c] for b in best]) if best else np.zeros(0, np.int64)) for c in (1, 0))],
                                         ["item", "doc_id", "score"])
    return run


def item_blocks(items: DataFrame, block_items: int) -> Iterator[list]:
    """The distinct items in blocks of about ``block_items``, each collected on its own."""
    distinct = items.distinct()
    blocks = max(1, -(-distinct.count() // block_items))
    for k in range(blocks):
        part = distinct.where(F.pmod(F.xxhash64("item_id", "text", F.lit(13)), F.lit(blocks)) == k)
        yield part.orderBy(F.col("item_id").asc_nulls_last(), "text").collect()


def lexical_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", k: int = 10, shard_rows: int = 16_384, block_items: int = 4096) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    Terms are runs of ASCII letters and digits and of any characters over
    U+007F, of whole texts; only A-Z are lower-cased. The score is the sum
    over an item's distinct terms of ``weight * impact`` in 64-bit integers, from the
    counts of all documents. Equal scores rank by the smaller id; documents with
    score 0 aren't returned.

    Items are taken in blocks of about ``block_items``; a block's texts and terms are held
    by every task, and each block counts and searches all documents. A task indexes
    ``shard_rows`` documents at a time and returns ``k`` rows an item. Results are
    those of scoring everything: bounds only spare work.

    A null or empty text has no term and no rank, and doesn't count among the
    documents. Rows that repeat an id are documents of their own; one
    with a null id counts in the statistics, but isn't returned. Equal rows of
    ``items`` are one item; rows of one id with different texts, and
    a null id, are items of their own. An item without terms has no rows. No
    documents or no items: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col)
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    found = spark.createDataFrame([], OUT_SCHEMA)
    for block in item_blocks(asked, block_items):
        vocabulary: dict[bytes, int] = {}
        queries = [sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(r["text"])}) for r in block]
        if not vocabulary:
            continue
        counted = write_table(texts.mapInArrow(_count(vocabulary), "doc_id long, n long, terms array<int>, counts array<long>"), "lexical")
        n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term of the block at most
            df[r["t"]] = r["count"]
        weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
        ranked = (counted.where((F.size("terms") > 0) & F.col("doc_id").isNotNull())
                  .mapInArrow(_search(queries, weights, n_docs, n_terms, k, shard_rows), "item int, doc_id long, score long"))
        best_first = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        top = ranked.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], "item int, item_id long")
        found = found.union(top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # a block of items
    return found


SEARCH_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM docs WHERE len(ts) > 0),
items AS (
  SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT i, item_id, unnest(ts) AS t FROM items),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM docs) GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
impact AS (
  SELECT tf.r, tf.t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(docs.ts) * n_docs) // n_terms))) AS s
  FROM tf JOIN df USING (t) JOIN docs USING (r), size WHERE t IN (SELECT t FROM asked)),
scored AS (SELECT i, item_id, r, sum(s) AS score FROM asked JOIN impact USING (t) GROUP BY i, item_id, r),
ranked AS (
  SELECT i, item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM scored JOIN docs USING (r) WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""
