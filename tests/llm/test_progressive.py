"""Centroid clustering, SimHash components and ranked search against brute force."""

import hashlib
import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD
from tests.llm.test_pairs import classes
from tests.oracle import compare, duck
from vitalis.llm import hadamard, lexical, simhash
from vitalis.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ["op11_hadamard_clusters", "op13_pair_maxscore"])
def test_queries_match_their_sql(spark, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE_SQL[name], duck(SF_SMALL))
    assert res["status"] == "ok" and res["rows"], res


# -- clusters


def plain_clusters(rows, components=64, centroids=16, rounds=3):
    """Rows of (id, vector) as the contract says it, in Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == components
            and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [64 * a // b for a, b in (float(x).as_integer_ratio() for x in v)], v) for i, v in kept]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v, w) for i, w, v in ints if i is not None)
    c = [w for _, _, w in named[:centroids]]

    def nearest(w):
        return min((sum((a - b) ** 2 for a, b in zip(w, k)), j) for j, k in enumerate(c))
    for _ in range(rounds):
        near = [nearest(w)[1] for _, w, _ in ints]
        for j in range(len(c)):
            mine = [w for (_, w, _), n in zip(ints, near) if n == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [nearest(w) for _, w, _ in ints]
    total = Counter()
    for d, j in last:
        total[j] += d
    return sorted(((i if i is not None else -1), j, d, total[j], sum(total.values()),
                   hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _, _), (d, j) in zip(ints, last))


def got_clusters(df, **more):
    return sorted(((r["vec_id"] if r["vec_id"] is not None else -1), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in hadamard.cluster(df, **more).collect())


def test_clusters_of_odd_rows_ties_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.integers(-2, 3, 8).astype(float).tolist()) for k in range(200)]
    rows += [(300 + k, [1.0, 2.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.5]) for k in range(100)]  # one common vector
    rows += [rows[0], rows[0], (5, [0.25] * 8), (None, [0.015625, -0.015625] * 4), (900, None), (901, []), (902, [1.0] * 7),
             (903, [float("nan")] * 8), (904, [float("-inf")] + [0.0] * 7), (905, [None] + [0.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as cluster", "1 as dim", "2 as v", "3 as vec", "4 as distance")
    for more in ({}, {"centroids": 3}, {"centroids": 500, "rounds": 1}):
        assert got_clusters(df, components=8, **more) == plain_clusters(rows, 8, **more)


def test_clusters_are_exact_for_large_components(spark):
    rows = [(k, [float(k % 7) * 3e6, -1e7 * k, 0.1, 2.0 ** 33]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got_clusters(df, components=4, centroids=4) == [
        t if max(t[2:5]) < 1 << 63 else (*t[:2], *(v if v < 1 << 63 else None for v in t[2:5]), t[5]) for t in plain_clusters(rows, 4, 4)]
    far = hadamard.cluster(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>"),
                           components=2, centroids=1).collect()
    assert [(r["distance"], r["cluster_inertia"], r["inertia"]) for r in far] == [(None, None, None)] * 2


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert hadamard.cluster(df).collect() == []
    assert hadamard.cluster(df.where("vec_id > 1"), components=1).collect() == []
    with pytest.raises(ValueError):
        hadamard.cluster(df, components=3)


def test_search_spares_work_and_is_exact():
    rng = np.random.default_rng(3)
    centre = rng.integers(-40, 40, (16, 64))
    x = centre[rng.integers(0, 16, 3000)] + rng.integers(-9, 10, (3000, 64))
    search = hadamard.ProgressiveSearch(centre.tolist())
    near, far = search.nearest(x)
    plain = ((x[:, None] - centre[None]) ** 2).sum(2)
    assert (near == plain.argmin(1)).all() and (far == plain.min(1)).all()
    assert search.added < 0.4 * x.size * 16


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-2 ** 70, 2 ** 70) | st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=6),
       st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=5))
def test_search_of_any_integers(x, centroids):
    near, far = hadamard.ProgressiveSearch(centroids, first=1).nearest(np.array(x, dtype=object))
    for v, j, d in zip(x, near.tolist(), far.tolist()):
        assert (d, j) == min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))


@given(st.integers(-2 ** 200, 2 ** 200))
def test_digits(v):
    assert sum(d << (hadamard.DIGIT * k) for k, d in enumerate(hadamard.digits(v))) == v


# -- SimHash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[k:k + 4]).encode(), seed=42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = classes(len(rows), [(a, b) for a, b in combinations(range(len(rows)), 2) if (fps[a] ^ fps[b]).bit_count() <= 4])
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i is None, i or 0, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, comp)), key=str)


def got_components(df, **more):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(df, **more).collect()), key=str)


def test_components_of_odd_rows(docs_of, empty):
    base = " ".join(f"w{k}" for k in range(400))
    rows = ODD + [(20 + k, base.replace(f"w{50 * k} ", "changed ")) for k in range(8)] + [(40, base.upper()), (41, base.replace(" ", "\n\t"))]
    assert got_components(docs_of(rows)) == plain_components(rows)
    assert simhash.simhash_components(empty).collect() == []


def test_components_of_given_documents(real):
    rows = [(r["doc_id"], r["text"]) for r in real("documents").select("doc_id", "text").collect()]
    assert got_components(real("documents"), shard_rows=32) == plain_components(rows)


@pytest.mark.parametrize("spread", [3, 7, 12])
def test_links_connect_as_all_pairs_do(spark, spread):
    """Random fingerprints, chains, and a group around one fingerprint, in shards that are cut into chunks."""
    rng = np.random.default_rng(spread)

    def around(v, n, most):
        out = []
        for _ in range(n):
            w = v
            for b in rng.choice(64, rng.integers(0, most + 1), replace=False):
                w ^= 1 << int(b)
            out.append(w)
        return out
    x = [int(v) for v in rng.integers(0, 2 ** 63, 600)] + [0, 1, 2 ** 64 - 1]
    x += around(x[0], 700, spread) + [w for k in range(1, 60) for w in around(x[k], 3, 5)]
    x = np.unique(np.array(x, np.uint64))
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    links = simhash.fingerprint_links(df, shard_rows=64, per_leaf=8).collect()
    at = {int(v): k for k, v in enumerate(x.view(np.int64))}
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4)
    assert all((int(x[at[r["a"]]]) ^ int(x[at[r["b"]]])).bit_count() <= 4 for r in links)
    assert classes(len(x), [(at[r["a"]], at[r["b"]]) for r in links]) == classes(len(x), zip(i.tolist(), j.tolist()))


def test_trees_prune_and_dense_groups_cost_little():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2 ** 63, 40_000).astype(np.uint64)
    mask, r = simhash.parts(4)[0]
    tree = simhash.ShardTree(x[::10], mask, r, 32, 0)
    assert tree.shards == 32
    row, shard = tree.met(x)
    assert len(row) < 0.25 * 32 * len(x)  # of all shards, few are met
    home = tree.home(x)
    assert np.bincount(home, minlength=32).max() < 4 * len(x) / 32
    local = simhash.LocalLinks(x[home == 3], mask, 4, r)
    local.inside()
    assert local.compared < 0.5 * (home == 3).sum() ** 2
    near = np.unique(x[0] ^ (np.uint64(1) << rng.integers(0, 64, (20_000, 2)).astype(np.uint64)).sum(1, dtype=np.uint64))
    dense = simhash.LocalLinks(near, mask, 4, r)
    links = dense.inside()
    assert sum(len(a) for a, _ in links) == len(near) - 1


# -- ranked search


def plain_search(rows, items, k=10):
    """The contract, document by document."""
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    docs = [(i, Counter(terms(t))) for i, t in rows]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        asked = set(terms(text))
        scored = []
        for i, c in docs:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got_search(*args, **more):
    return sorted((tuple(r) for r in lexical.lexical_search(*args, **more).collect()), key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as rank", "1 as score", "2 as item", "3 as n", "4 as terms")


def test_search_of_odd_rows(spark, docs_of, empty):
    items = [(1, "one TWO three wort wort zzz"), (1, "one TWO three wort wort zzz"), (2, None), (3, "..."), (4, "漢字 Ünïcode x'd 123"),
             (None, "several words without x"), (5, "x"), (5, "456 ends")]
    rows = ODD + [(100 + k, f"one two copy {k % 3}") for k in range(60)] + [(-1, "one two copy")]
    for more in ({}, {"shard_rows": 7, "block_items": 2}, {"k": 2, "shard_rows": 16}):
        assert got_search(docs_of(rows), items_of(spark, items), **more) == plain_search(rows, items, more.get("k", 10))
    assert got_search(empty, items_of(spark, items)) == got_search(docs_of(rows), items_of(spark, items).where("item_id > 9")) == []


def index_of(docs, k=10):
    names = sorted({t for d in docs for t in d})
    at = {t: j for j, t in enumerate(names)}
    doc, term, impact = zip(*[(i, at[t], w) for i, d in enumerate(docs) for t, w in d.items()])
    made = lexical.ShardIndex(np.arange(len(docs)), *map(np.array, (doc, term, impact)), len(names), k, block=8)
    return made, at


def test_pair_bounds_are_bounds_and_tighter():
    rng = np.random.default_rng(8)
    docs = [{t: int(rng.integers(1, 100)) for t in rng.choice(12, rng.integers(1, 7), replace=False).tolist()} for _ in range(2000)]
    index, at = index_of(docs)
    index.intersect(combinations(range(12), 2))
    terms = list(range(8))
    with_pairs, alone = index.bounds(terms), index.bounds(terms, pairs=False)
    for j in range(len(terms)):
        most = np.zeros(index.blocks, np.int64)
        for i, d in enumerate(docs):
            most[i // 8] = max(most[i // 8], sum(w for t, w in d.items() if at[t] in terms[j:]))
        assert (most <= with_pairs[j]).all() and (with_pairs[j] <= alone[j]).all()
    assert with_pairs[0].sum() < 0.95 * alone[0].sum()
    scores, ids, scored = index.search(list(range(8)), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    plain = sorted((-sum(w for t, w in d.items() if at[t] < 8), i) for i, d in enumerate(docs))[:10]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == plain
    assert scored < 0.1 * len(docs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 5), st.integers(1, 4), max_size=5), min_size=1, max_size=60), st.integers(1, 4))
def test_search_equals_scoring_all(docs, k):
    if not any(docs):
        return
    index, at = index_of(docs, k)
    index.intersect(combinations(range(len(at)), 2))
    scores, ids, _ = index.search(list(range(len(at))), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    plain = sorted((-sum(d.values()), i) for i, d in enumerate(docs) if d)[:k]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == plain
