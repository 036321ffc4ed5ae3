"""Centroid clustering by a progressive search in the Walsh-Hadamard domain.

The unnormalised transform of an integer vector is an integer vector, and the
squared difference of two transforms is the number of components times the
squared difference of the vectors. So the differences of coefficients, added up
from coarse (few sign changes) to fine, bound the distance from below: a
centroid whose sum exceeds a distance that is already known is strictly worse
and drops out. Who is left at the end has all its coefficients added up, which
is its distance, exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import named, write_table

OUT_SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
LONG_MAX = (1 << 63) - 1
#: Rows searched at a time: their differences to all centroids are held at once.
SLICE = 4096
#: Components up to this size have distances within 64 bits: 2^21, differences
#: 2^22, coefficients 2^28 and 64 squares of them 2^62. It shrinks with the length.
SAFE = 1 << 21
#: Sums travel in digits of so many bits, which long sums of them can't exceed.
DIGIT = 32


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (a power of two long), in natural order."""
    n, d = x.shape
    x, h = x.copy(), 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x


def coarse_to_fine(d: int) -> np.ndarray:
    """Positions of the coefficients in the order of their sign changes."""
    rows = transform(np.eye(d, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(1), kind="stable")


def floors(scale: int, vectors: list[list[float]]) -> np.ndarray:
    """floor(scale * x) of every component, exactly, as Python integers."""
    def one(x: float) -> int:
        over, under = float(x).as_integer_ratio()
        return scale * over // under
    return np.array([[one(x) for x in v] for v in vectors], dtype=object)


class ProgressiveSearch:
    """Nearest of some integer centroids, for many integer vectors."""

    def __init__(self, centroids: list[list[int]], first: int = 8):
        d = len(centroids[0])
        self.order = coarse_to_fine(d)
        self.narrow = all(abs(v) <= SAFE * 64 // max(d, 64) for c in centroids for v in c)
        self.limit = SAFE * 64 // max(d, 64)
        self.wide = transform(np.array(centroids, dtype=object))[:, self.order]
        self.coefficients = self.wide.astype(np.int64) if self.narrow else None
        self.d, first = d, min(first, d)
        cuts = [first]
        while cuts[-1] < d:
            cuts.append(min(d, 2 * cuts[-1]))
        self.bands = list(zip(cuts, cuts[1:]))
        self.first = first
        self.added = 0  # coefficient differences added up so far

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (ties: the smaller) and the squared
        distance to it. Rows of 64-bit integers are fast if they and the
        centroids are within bounds; others are reckoned in Python integers."""
        cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), object)
        fits = np.array([self.narrow and all(abs(v) <= self.limit for v in row) for row in x], bool) if x.dtype == object \
            else np.full(len(x), self.narrow) & (np.abs(x) <= self.limit).all(1)
        for rows, kind in ((np.flatnonzero(fits), np.int64), (np.flatnonzero(~fits), object)):
            for at in range(0, len(rows), SLICE):
                some = rows[at:at + SLICE]
                cluster[some], distance[some] = self._search(x[some].astype(kind), kind)
        return cluster, distance

    def _search(self, x: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
        c = self.coefficients if kind is np.int64 else self.wide
        n, k = len(x), len(c)
        x = transform(x)[:, self.order]
        coarse = ((x[:, None, :self.first] - c[None, :, :self.first]) ** 2).sum(2)
        # The best by coarse coefficients is finished first: a distance to beat.
        lead = np.argmin(coarse, axis=1)
        rest = x[:, self.first:] - c[lead, self.first:]
        bound = coarse[np.arange(n), lead] + ((rest * rest).sum(1) if rest.shape[1] else 0)
        self.added += n * k * self.first + rest.size
        alive = coarse <= bound[:, None]
        row, cen = np.nonzero(alive)
        part = coarse[row, cen]
        for a, b in self.bands:
            gap = x[row, a:b] - c[cen, a:b]
            part = part + (gap * gap).sum(1)
            self.added += gap.size
            left = part <= bound[row]  # equal ones stay, so ties are seen
            row, cen, part = row[left], cen[left], part[left]
        # Each vector has its lead at least; pairs are in order of vector, then centroid.
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        least = np.minimum.reduceat(part, starts)
        best = np.flatnonzero(part == np.repeat(least, np.diff(np.r_[starts, len(row)])))
        best = best[np.r_[True, row[best][1:] != row[best][:-1]]]
        return cen[best], (part[best] // self.d).astype(object)


def _integers(column: pa.Array, scale: int, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)
    if (np.abs(flat) * scale < SAFE).all():
        return np.floor(flat * scale).astype(np.int64)
    return floors(scale, flat.tolist())


def digits(value: int) -> list[int]:
    """Digits of base 2^32, least first, all with the sign of the value."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << DIGIT) - 1)))
        value >>= DIGIT
    return out


def _sums(centroids: list[list[int]], scale: int):
    """Sums of the vectors of each cluster, as digits; the count is dimension -1."""
    d = len(centroids[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = ProgressiveSearch(centroids)
        total = np.zeros((len(centroids), d + 1), object)
        for b in batches:
            if b.num_rows:
                x = _integers(named(b, "vec"), scale, d)
                near, _ = search.nearest(x)
                for c in np.unique(near).tolist():
                    mine = x[near == c]
                    # Rows of a batch that fit SAFE can't sum beyond 64 bits.
                    total[c, :d] += mine.sum(0).astype(object)
                    total[c, d] += len(mine)
        rows = [(c, j, p, v) for c in range(len(centroids)) for j in range(d + 1)
                for p, v in enumerate(digits(int(total[c, j])))]
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                                          pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())], ["cluster", "dim", "place", "v"])
    return run


def _assign(centroids: list[list[int]], scale: int):
    d = len(centroids[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = ProgressiveSearch(centroids)
        for b in batches:
            near, far = search.nearest(_integers(named(b, "vec"), scale, d)) if b.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [named(b, "vec_id"), pa.array(near, pa.int32()), pa.array([v if v <= LONG_MAX else None for v in far], pa.int64())],
                ["vec_id", "cluster", "distance"])
    return run


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, components: int) -> DataFrame:
    """``vec_id, vec`` of the vectors that take part."""
    v = F.col("vec")
    finite = ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec"))
            .where((F.size(v) == components) & finite))


def start(kept: DataFrame, centroids: int, seed: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id, as integers."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = (kept.where("vec_id is not null").select(by.alias("by"), "vec")
             .orderBy("by", "vec").limit(centroids).collect())
    return floors(scale, [r["vec"] for r in first]).tolist()


def updated(kept: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """One round: the floored means of all clusters; an empty one keeps its centroid."""
    d = len(centroids[0])
    rows = (kept.mapInArrow(_sums(centroids, scale), "cluster int, dim int, place int, v long")
            .groupBy("cluster", "dim", "place").agg(F.sum("v").alias("v")).collect())  # clusters x components x digits at most
    total = np.zeros((len(centroids), d + 1), object)
    for r in rows:
        total[r["cluster"], r["dim"]] += r["v"] << (DIGIT * r["place"])
    return [[s // t[d] for s in t[:d]] if t[d] else old for t, old in zip(total.tolist(), centroids)]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 64,
            centroids: int = 16, rounds: int = 3, seed: int = 1, scale: int = 64) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid``
    of every vector with exactly ``components`` components (a power of two),
    none null or non-finite; others take no part.

    A component x counts as the integer floor(scale * x). Clusters start from
    the ``centroids`` vectors with the smallest SHA-256 of ``seed:id`` (equal
    ids: in the order of the vectors), and fewer if there are fewer. Each of
    the ``rounds`` assigns all vectors to the nearest centroid (ties: the
    smaller number) and replaces each centroid that has vectors by the floor of
    their mean. A last assignment follows. All numbers are exact, whatever the
    size of the components; a distance or inertia over 2^63 - 1 is null.

    Only centroids and their sums (clusters times components) reach the
    driver; a round is one scan whose tasks return sums. Rows that repeat an id
    each count. A row with a null id is assigned, but no start; if no row
    has an id there are no clusters and no rows. Other columns are ignored.
    """
    if components < 1 or components & (components - 1):
        raise ValueError("the number of components must be a power of two")
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, id_col, vector_col, components)
    now = start(kept, centroids, seed, scale)
    if not now:
        return spark.createDataFrame([], f"{OUT_SCHEMA}, centroid array<string>")
    for _ in range(rounds):
        now = updated(kept, now, scale)
    assigned = write_table(kept.mapInArrow(_assign(now, scale), "vec_id long, cluster int, distance long"), "clusters")
    # A null distance is beyond the range, and so is each sum over it.
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(20,0)")))
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(whole.alias("s")).collect()}
    everything = None if None in sums.values() else int(sum(sums.values()))

    def fits(v) -> int | None:
        return int(v) if v is not None and v <= LONG_MAX else None

    about = spark.createDataFrame([(c, fits(s), fits(everything), [str(v) for v in now[c]]) for c, s in sums.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<string>")
    about = about.withColumn("centroid_sha256", F.sha2(F.concat_ws(",", "centroid"), 256))
    return (assigned.join(F.broadcast(about), "cluster")  # one row per cluster
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"))


def clusters_sql(rounds: int = 3) -> str:
    """DuckDB SQL for :func:`cluster` of ``embeddings``, with its defaults."""
    steps = ["""WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
    embedding
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS (SELECT r, unnest(range(64)) AS d, unnest(v) AS x FROM kept),
c0 AS (
  SELECT k, unnest(range(64)) AS d, unnest(v) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) - 1 AS k, v FROM kept WHERE vec_id IS NOT NULL) WHERE k < 16)"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS (
  SELECT r, arg_min(k, (s, k)) AS k, min(s) AS s FROM (
    SELECT r, k, sum((long.x - c{t}.x) * (long.x - c{t}.x)) AS s FROM long JOIN c{t} USING (d) GROUP BY r, k) GROUP BY r)""")
        if t < rounds:
            steps.append(f"""m{t} AS (
  SELECT k, d, sum(x) AS s, count(*) AS n FROM long JOIN a{t} USING (r) GROUP BY k, d),
c{t + 1} AS (
  SELECT k, d, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{t} LEFT JOIN m{t} USING (k, d))""")
    return ",\n".join(steps) + f""",
digest AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance, CAST(sum(s) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN digest USING (k)"""
