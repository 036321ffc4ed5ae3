"""Search and deduplication against brute force."""

import os
import random
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalis.llm import ann, common, components, line_dedup, minhash, substring_dedup
from tests.llm.conftest import ODD


def classes(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


# -- nearest neighbours


def exact(x, ids, q, k):
    score = (x * x[q]).sum(1)
    rows = [r for r in range(len(ids)) if ids[r] != ids[q]]
    return sorted(rows, key=lambda r: (-score[r], ids[r]))[:k]


def test_search_recall_and_scores(spark, real):
    vectors = real("embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    got = {}
    for r in ann.search(vectors).collect():
        got.setdefault(r["query_id"], []).append(r)
    hit = wanted = 0
    for q in np.flatnonzero(ids % 20 == 0):
        best = ids[exact(x, ids, q, 20)]
        mine = sorted(got[ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        for r in mine:
            assert r["score"] == pytest.approx(float(x[q] @ x[ids == r["vec_id"]][0]), abs=1e-12)
        hit += len(set(best) & {r["vec_id"] for r in mine})
        wanted += len(best)
    assert hit >= 0.9 * wanted


def test_search_visiting_everything_is_exact_with_ties_and_odd_rows(spark):
    rng = random.Random(4)
    rows = [(k, [float(rng.randint(-2, 2)) for _ in range(5)]) for k in range(300)]
    rows += [(1000 + k, [1.0, 2.0, 0.0, 0.0, 1.0]) for k in range(40)]  # one common vector
    rows += [(20, rows[20][1]), (2000, None), (2020, [0.0] * 5), (2040, [1.0, None, 1.0, 1.0, 1.0]), (2060, [float("nan")] * 5),
             (2080, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 5), (2100, []), (2120, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as cell", "1 as block", "2 as vec", "3 as score")
    good = {}
    for i, v in rows:
        if i is not None and i < 2000 and v and any(v):
            good[i] = np.array(v)
    got = {}
    for r in ann.search(df, visit_share=1.0, centroids=4, block_rows=32, block_queries=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in good if i % 20 == 0}
    for q, mine in got.items():
        best = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))[:20]
        assert [(i, -s) for s, i in best] == [(i, s) for _, i, s in sorted(mine)]


def test_search_empty_and_few(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert ann.search(one.where("vec_id < 0")).count() == 0
    assert [tuple(r) for r in ann.search(one).collect()] == [(0, 1, 1, 4.0)]


def test_walk_is_in_order_of_summed_products():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 6))
    index = ann.MultiIndex(x, 8)
    index.fill(np.bincount(index.cells(x), minlength=64), 50)
    q = rng.standard_normal(6)
    walked = index.walk(q, 400)
    sums = [float(index.books[0][c // 8] @ q[:3] + index.books[1][c % 8] @ q[3:]) for c in walked]
    assert sums == sorted(sums, reverse=True) and set(walked) == set(np.flatnonzero(index.counts))


# -- components


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    links += [(2000, 2000 + k) for k in range(1, 300)]
    got = {r["node"]: r["comp"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = classes(2400, links)
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: root[n] for n in nodes}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_verified_links_connect_across_chunks(spark):
    rows = [(k, 7 if k < 90 else 8 + k % 3) for k in range(120)]
    close = lambda x, y: abs(x - y) in (3, 40)
    df = spark.createDataFrame(rows, "node long, comp long")
    got = [(r["a"], r["b"]) for r in components.verified_links(df, lambda r: r["node"], close, block=8).collect()]
    comp = dict(rows)
    every = [(a, b) for a, b in combinations(range(120), 2) if comp[a] == comp[b] and close(a, b)]
    assert all(close(a, b) and comp[a] == comp[b] for a, b in got)
    assert classes(120, got) == classes(120, every)


# -- near-duplicate documents


def naive_similarity(a, b):
    p, q = (dict(zip(k.tolist(), w)) for k, w in (a, b))
    return sum(1.0 / sum(max(p.get(e, 0) / p[d], q.get(e, 0) / q[d]) for e in p.keys() | q.keys()) for d in p.keys() & q.keys())


def test_probability_jaccard_and_its_estimate():
    rng = random.Random(3)
    pairs = []
    for _ in range(60):
        a = [f"w{rng.randrange(30)}".encode() for _ in range(80)]
        b = a[:rng.randrange(20, 80)] + [f"v{rng.randrange(30)}".encode() for _ in range(rng.randrange(25))]
        pairs.append((minhash.weights(a, 2), minhash.weights(b, 2)))
    for a, b in pairs:
        assert minhash.probability_jaccard(a, b) == pytest.approx(naive_similarity(a, b), abs=1e-12)

    def sign(items):
        owner = np.concatenate([np.full(len(k), n) for n, (k, _) in enumerate(items)])
        return minhash.signatures(owner, np.concatenate([k for k, _ in items]), np.concatenate([w for _, w in items]), len(items), 600)
    found = (sign([a for a, _ in pairs]) == sign([b for _, b in pairs])).mean(1)
    wanted = np.array([minhash.probability_jaccard(a, b) for a, b in pairs])
    assert abs((found - wanted).mean()) < 0.01 and np.abs(found - wanted).max() < 0.1


def test_near_duplicates_match_all_pairs(spark, real):
    docs = real("documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    # More near copies: a chain of texts, each one word away from the last.
    chain = texts[0].split()[:80]
    more = []
    for k in range(40):
        chain = chain[:2 * k] + [f"new{k}"] + chain[2 * k + 1:]
        more.append((10_000 + k, " ".join(chain)))
    texts |= dict(more)
    table = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    ids = sorted(texts)
    w = [minhash.weights(minhash.words_of(texts[i])) for i in ids]
    links = [(a, b) for a, b in combinations(range(len(ids)), 2)
             if np.intersect1d(w[a][0], w[b][0]).size and minhash.probability_jaccard(w[a], w[b]) >= 0.8]
    root = classes(len(ids), links)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(table, block=8).collect()}
    assert {i: got[i]["class_id"] for i in ids} == {i: ids[root[k]] for k, i in enumerate(ids)}
    assert all(got[i]["kept"] == (got[i]["class_id"] == i) for i in ids)


def test_near_duplicates_odd_rows(odd, empty):
    got = sorted((tuple(r) for r in minhash.near_duplicates(odd).collect()), key=str)
    assert len(got) == len(ODD)
    by = {r[0]: r for r in got}
    assert by[4] == (4, 4, 3, True) and by[7] == (7, 4, 3, False)
    assert all(by[i][1:] == (i, 1, True) for i in (1, 2, 3, 5, 6, 8, 9, None))
    assert minhash.near_duplicates(empty).count() == 0


# -- lines


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(14))) for _ in "ab")
        assert line_dedup.edit_distance(a, b) == levenshtein(a, b)


def test_simhash_is_the_weighted_majority():
    mask = (1 << 64) - 1

    def hashed(word):
        h = sum((c + 1) * pow(0x9E3779B97F4A7C15, k % 4096 + 1, 1 << 64) for k, c in enumerate(word)) & mask
        h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & mask
        h = (h ^ (h >> 27)) * 0x94D049BB133111EB & mask
        return (h ^ (h >> 31)).to_bytes(8, "little")
    rng = random.Random(6)
    lines = [" ".join("xé" * rng.randrange(1, 9) + str(rng.randrange(50)) for _ in range(rng.choice([1, 2, 30, 255, 256, 257, 900]))) for _ in range(60)]
    lines += ["y" * 9000, " ".join(["z" * 300] * 600), "one"]
    for line, got in zip(lines, line_dedup.fingerprints([x.encode() for x in lines])[0].tolist()):
        votes = [0] * 64
        for w in line.encode().split(b" "):
            raw = hashed(w)
            for b in range(64):
                votes[b] += min(len(w), 255) * (1 if raw[b // 8] >> (7 - b % 8) & 1 else -1)
        want = bytes(sum(1 << (7 - j) for j in range(8) if votes[8 * k + j] > 0) for k in range(8))
        assert got == int.from_bytes(want, "little")


def line_forms(texts):
    places = {}
    for i, text in texts:
        for k, line in enumerate((text or "").split("\n")):
            form = line_dedup.normal_form(line)
            if form and i is not None:
                places.setdefault(form, set()).add((i, k))
    return places


def brute_lines(texts, distance=20, similarity=0.8):
    """Classes by the operator's rule, all pairs compared."""
    places = line_forms(texts)
    forms = list(places)
    h, keys = line_dedup.fingerprints([f.encode() for f in forms])
    h, keys = h.tolist(), [set(k) - {0} for k in keys.tolist()]
    close = [(a, b) for a, b in combinations(range(len(forms)), 2) if (h[a] ^ h[b]).bit_count() <= distance]
    group = classes(len(forms), [(a, b) for a, b in close if keys[a] & keys[b] or h[a] == h[b]])
    links = [(a, b) for a, b in close if group[a] == group[b]
             and line_dedup.edit_similarity(forms[a], forms[b]) >= similarity]
    root = classes(len(forms), links)
    keep = {}
    for k, f in enumerate(forms):
        keep[root[k]] = min([keep.get(root[k], (1 << 60, 0)), *places[f]])
    return {p: keep[root[k]] for k, f in enumerate(forms) for p in places[f]}, len(links)


def test_line_classes_match_all_pairs(spark, real):
    docs = real("documents").select("doc_id", "text").where("length(text) < 4000")
    base = " ".join(f"common{k}" for k in range(60))
    more = [(50_000 + k, f"{base} tail{k}\n{base.replace(f'common{k}', 'x')}\nShort line.") for k in range(40)]
    table = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    want, links = brute_lines([(r["doc_id"], r["text"]) for r in table.collect()])
    assert links > 50
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.line_classes(table, block=8).collect()}
    assert got == want


def test_recall_against_edit_similarity_alone(real):
    texts = [(r["doc_id"], r["text"]) for r in real("documents").where("length(text) < 4000").collect()]
    places = line_forms(texts)
    forms = sorted(places, key=len)
    sizes = np.array([len(f) for f in forms])
    letters = np.array([np.bincount(np.frombuffer(f.encode("utf-32-le"), np.uint32) % 256, minlength=256) for f in forms])
    similar = []
    for k, a in enumerate(forms):
        # An edit changes two letter counts by one at most.
        apart = np.abs(letters[k + 1:] - letters[k]).sum(axis=1)
        for b in np.flatnonzero(apart <= 0.4 * sizes[k + 1:]) + k + 1:
            if line_dedup.similar_forms(a, forms[b], 0.8):
                similar.append((a, forms[b]))
    found = brute_lines(texts)[0]
    together = sum(found[min(places[a])] == found[min(places[b])] for a, b in similar)
    assert len(similar) > 30 and together >= 0.9 * len(similar)


@pytest.mark.parametrize("words, floor", [(5, 0.8), (8, 0.9), (12, 0.9), (20, 0.9), (40, 0.9), (80, 0.9), (400, 0.9)])
def test_changed_lines_meet_by_length(words, floor):
    rng = random.Random(words)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(5000)]
    found = tried = 0
    for k in range(500):
        a = [vocabulary[int(min(4999, rng.paretovariate(0.6)))] for _ in range(words)]
        b = list(a)
        if k % 3 == 0:  # one letter
            at = rng.randrange(words)
            b[at] = "x" + b[at][1:]
        else:  # a word, or a word in twenty
            for at in rng.sample(range(words), 1 if k % 3 == 1 else max(1, words // 20)):
                b[at] = rng.choice(vocabulary)
        x, y = " ".join(a), " ".join(b)
        if x == y or line_dedup.edit_similarity(x, y) < 0.8:
            continue
        tried += 1
        h, keys = line_dedup.fingerprints([x.encode(), y.encode()])
        found += bool((set(keys[0].tolist()) & set(keys[1].tolist())) - {0}) and int(h[0] ^ h[1]).bit_count() <= 20
    assert tried > 200 and found >= floor * tried


def test_block_keys_by_hand():
    lines = ["one two three four five six seven", "y" * 50, "la ja", " ".join(f"word{k}" for k in range(90)), "b " * 60 + "end", "a b"]
    h, keys = line_dedup.fingerprints([x.strip().encode() for x in lines])
    alone = line_dedup.fingerprints([lines[3].encode()])
    assert h[3] == alone[0][0] and keys[3].tolist() == alone[1][0].tolist()
    turned = line_dedup.fingerprints([" ".join(reversed(lines[3].split())).encode()])
    assert turned[1][0].tolist() == keys[3].tolist()
    assert (keys[3] != 0).sum() == 12 and (keys[1] != 0).sum() == 4 and (keys[5] != 0).sum() == 2
    changed = line_dedup.fingerprints([lines[3].replace("word7 ", "other ").encode()])[1][0]
    assert (changed != keys[3]).sum() <= 2


def test_similar_forms_is_the_edit_similarity():
    rng = random.Random(8)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(40)))
        b = "".join(c if rng.random() > 0.15 else rng.choice(["", "x", c + "y"]) for c in a)
        for s in (0.5, 0.8, 0.9):
            assert line_dedup.similar_forms(a, b, s) == (1 - levenshtein(a, b) / max(1, len(a), len(b)) >= s)


def test_similar_pairs_are_similar_forms():
    rng = random.Random(9)
    a, b = [], []
    for k in range(400):
        x = "".join(rng.choice("abc\u65e5\U0001f600" if k % 2 else "abcd") for _ in range(rng.randrange(1, 1200 if k % 40 == 0 else 60)))
        a.append(x)
        b.append("".join(c if rng.random() > 0.12 else rng.choice(["", "x", c + "y"]) for c in x) or "z")
    for some in (slice(None), slice(0, None, 2), slice(0, 9)):
        for s in (0.0, 0.5, 0.8, 0.9, 1.0):
            want = [line_dedup.similar_forms(x, y, s) for x, y in zip(a[some], b[some])]
            assert line_dedup.similar_pairs(a[some], b[some], s).tolist() == want


def test_near_links_connect_what_all_pairs_would():
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    h = rng.choice(seeds, 150) ^ (np.uint64(1) << rng.integers(0, 63, 150).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 63, 150).astype(np.uint64))
    kind, side = rng.integers(0, 2, 150), rng.integers(0, 3, 150)
    for chunk in (None, side):
        for alike in (None, lambda x, y: kind[x] == kind[y]):
            asked = []

            def similar(xs, ys):
                asked.extend(zip(xs.tolist(), ys.tolist()))
                return kind[xs] == kind[ys]

            pairs = [(a, b) for a, b in combinations(range(150), 2) if int(h[a] ^ h[b]).bit_count() <= 4
                     and (chunk is None or chunk[a] != chunk[b])]
            got = list(line_dedup.near_links(h, chunk, 4, similar if alike else None))
            assert classes(150, got) == classes(150, [(a, b) for a, b in pairs if alike is None or alike(a, b)])
            assert len(got) < 150 and set(got) <= set(pairs) and len(asked) == len(set(asked)) and len(asked) < len(pairs)


def test_a_large_group_is_cut_by_length_and_compared_whole(spark):
    rng = random.Random(5)
    forms = ["".join(rng.choice("ab") for _ in range(rng.randrange(4, 40))) for _ in range(120)]
    forms += [f + "c" for f in forms[::3]]
    members = (spark.createDataFrame([(f.encode(), 1, 0, len(f), f) for f in forms], "node binary, comp long, simhash long, size int, form string")
               .dropDuplicates(["node"]).withColumn("band", line_dedup.length_band(F.col("size"), 0.8)))
    cells = (members.groupBy("comp", "band").agg(F.ceil(F.count("*") / 7).alias("parts"))
             .groupBy("comp").agg(F.collect_list(F.struct("band", "parts")).alias("cells")))
    links = [(r["a"].decode(), r["b"].decode()) for r in line_dedup.form_links(members.drop("size"), cells, 20, 0.8, 3).collect()]
    names = sorted(set(forms))
    at = {f: k for k, f in enumerate(names)}
    every = [(a, b) for a, b in combinations(range(len(names)), 2) if line_dedup.similar_forms(names[a], names[b], 0.8)]
    assert classes(len(names), [(at[a], at[b]) for a, b in links]) == classes(len(names), every)


def test_rounds_meet_each_pair_of_chunks_once(spark):
    rng = random.Random(6)
    forms = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(4, 40))) for _ in range(150)})
    members = (spark.createDataFrame([(f.encode(), 1, 0, len(f), f) for f in forms], "node binary, comp long, simhash long, size int, form string")
               .withColumn("band", line_dedup.length_band(F.col("size"), 0.8)))
    cells = (members.groupBy("comp", "band").agg(F.ceil(F.count("*") / 7).alias("parts"), F.sum("size").alias("size"))
             .groupBy("comp").agg(F.collect_list(F.struct("band", "parts", "size")).alias("cells")))
    sized = {x["band"]: (x["parts"], x["size"]) for x in cells.first()["cells"]}
    copies = sum(n * p for b, (_, n) in sized.items() for o, (p, _) in sized.items() if abs(b - o) <= 1)
    assert line_dedup.rounds_of(cells, copies) == 1 and line_dedup.rounds_of(cells, copies // 4) in (4, 5)
    assert line_dedup.rounds_of(cells.where("comp = 2"), 100) == 1
    members = members.drop("size")
    rounds = [[(r["a"].decode(), r["b"].decode()) for r in line_dedup.form_links(members, cells, 20, 0.8, 3, k, 4).collect()] for k in range(4)]
    assert sum(map(bool, rounds)) > 1
    whole = [(r["a"].decode(), r["b"].decode()) for r in line_dedup.form_links(members, cells, 20, 0.8, 3).collect()]
    assert sorted(x for r in rounds for x in r) == sorted(whole)


def test_line_classes_are_the_same_in_rounds(spark, monkeypatch):
    base = [f"common{k}" for k in range(60)]
    texts = [(k, " ".join([*base, f"tail{k}"]) + "\n" + " ".join(base[:k] + base[k + 1:])) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want, _ = brute_lines(texts)
    made, one = [], line_dedup.form_links
    monkeypatch.setattr(line_dedup, "form_links", lambda *given: made.append(given[5:]) or one(*given))
    monkeypatch.setattr(line_dedup, "rounds_of", lambda cells, size: 3)
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.line_classes(docs, block=8).collect()}
    assert got == want and made == [(k, 3) for k in range(3)]


def test_copies_of_a_group_grow_with_its_lines(spark, monkeypatch):
    def chunks(n):
        seen = []

        def told(forms, cells, *more):
            seen.append(cells.select(F.explode("cells").alias("x")).agg(F.sum("x.parts")).first()[0])
            return one(forms, cells, *more)

        one = line_dedup.form_links
        with monkeypatch.context() as m:
            m.setattr(line_dedup, "form_links", told)
            base = " ".join(f"common{k}" for k in range(30))
            line_dedup.line_classes(spark.createDataFrame([(k, f"{base} tail{k}") for k in range(n)], "doc_id long, text string"), block=4).count()
        return seen[-1]

    assert chunks(400) <= 10  # a hundred blocks of four lines


def test_profiles_exclude_no_similar_pair():
    rng = random.Random(10)
    forms = ["".join(rng.choice("ab\u65e5\U0001f600") for _ in range(rng.randrange(0, 60))) for _ in range(150)]
    forms += ["".join(c if rng.random() > 0.15 else rng.choice(["", "x", c + "y"]) for c in f) for f in forms] + ["a" * 700, "a" * 800]
    counts, sizes = line_dedup.profiles(forms), np.array([len(f) for f in forms])
    xs, ys = (np.array(x) for x in zip(*combinations(range(len(forms)), 2)))
    for s in (0.5, 0.8, 1.0):
        left = set(line_dedup.may_be_similar(counts, sizes, xs, ys, s).tolist())
        similar = set(np.flatnonzero(line_dedup.similar_pairs([forms[x] for x in xs], [forms[y] for y in ys], s)).tolist())
        assert similar <= left and len(left) < len(xs)


def test_shuffles_of_a_written_table_are_removed(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {x for x in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    before = shuffled()
    table = common.write_table(spark.range(5000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "counts")
    for _ in range(50):  # they are removed in the background
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert sorted(r["k"] for r in table.collect()) == list(range(7))
    common.drop_table(table)
    assert not os.path.exists(table.table_path)


def test_line_classes_and_removal_of_odd_rows(odd, empty):
    classes_ = line_dedup.line_classes(odd)
    rows = {tuple(r) for r in classes_.collect()}
    assert rows == {(4, 0, 4, 0, True), (7, 0, 4, 0, False), (5, 0, 5, 0, True), (6, 0, 6, 0, True), (8, 0, 8, 0, True), (9, 0, 9, 0, True)}
    left = line_dedup.remove_lines(odd, classes_)
    assert left.columns == odd.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted([r for r in ODD if r[0] != 7], key=str)
    assert line_dedup.line_classes(empty).count() == 0


def test_removed_lines_leave_the_others(docs_of):
    docs = docs_of([(1, "alpha beta gamma\n\nown words here"), (2, "other start\nALPHA, beta: gamma!\n\nmore"), (3, "alpha beta gamma")])
    left = {r["doc_id"]: r["text"] for r in line_dedup.remove_lines(docs, line_dedup.line_classes(docs)).collect()}
    assert left == {1: "alpha beta gamma\n\nown words here", 2: "other start\n\nmore"}


def test_typographic_variants_are_equal_lines(docs_of):
    plain = "it s a so called test wait and see"
    variants = ["It's a so-called \"test\" - wait... and see", "It\u2019s a so\u2011called \u201ctest\u201d \u2014 wait\u2026 and see",
                "\u2022 It\u2018s\u00a0a so\u2013called \u00abtest\u00bb\u3000wait\u2026 and\u202fsee"]
    assert {line_dedup.normal_form(v) for v in variants} == {plain}
    assert [line_dedup.normal_form(v) for v in ("\u2014\u2014\u2014", "\u2022 \u2022 \u2022", "\u00a0")] == [""] * 3
    # Letters and the signs that belong to them stay.
    assert line_dedup.normal_form("\u00c9t\u00e9, \u0915\u093f \u65e5\u672c\u3002") == "\u00e9t\u00e9 \u0915\u093f \u65e5\u672c"
    docs = docs_of([(1, f"{variants[0]}\n\u2014\u2014\u2014\nfirst words"), (2, f"{variants[1]}\n\u2014\u2014\u2014\nother things here"),
                    (3, f"{variants[2]}\n\u2014\u2014\u2014")])
    left = {r["doc_id"]: r["text"] for r in line_dedup.remove_lines(docs, line_dedup.line_classes(docs)).collect()}
    assert left == {1: docs.where("doc_id = 1").first()["text"], 2: "\u2014\u2014\u2014\nother things here"}


# -- passages


def brute_passages(texts, passage_words=16):
    seen, out = {}, []
    for i, text in sorted(texts):
        run = []

        def close():
            if sum(u[2] for u in run) >= passage_words:
                out.append((i, run[0][0], run[-1][1], len(run), sum(u[2] for u in run), run[0][4]))
            run.clear()
        for u in substring_dedup.units(text or ""):
            if u[3] in seen:
                run.append((*u, seen[u[3]]))
            else:
                seen[u[3]] = i
                close()
        close()
    return sorted(out)


def test_passages_match_brute_force_and_sql(real):
    import duckdb
    docs = real("documents")
    want = brute_passages([(r["doc_id"], r["text"]) for r in docs.collect()])
    columns = ["doc_id", "start", "end", "n_units", "n_words", "first_doc_id"]
    assert len(want) > 5 and sorted(tuple(r) for r in substring_dedup.repeated_passages(docs).select(columns).collect()) == want
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(con.sql(substring_dedup.PASSAGES_SQL).fetchall()) == want


def test_a_passage_inside_lines_is_found(docs_of):
    rng = random.Random(9)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" + ("." if k % 7 == 6 else "") for k in range(n))
    passage = say(63)
    texts = [(k, f"{say(40)} {passage} {say(40)}") for k in range(3)] + [(3, say(200))]
    rows = substring_dedup.repeated_passages(docs_of(texts)).collect()
    assert {r["doc_id"] for r in rows} == {1, 2} and all(r["first_doc_id"] == 0 and r["n_words"] >= 49 for r in rows)
    for r in rows:
        assert texts[r["doc_id"]][1][r["start"]:r["end"]].strip() in passage


def test_nothing_unique_lies_inside_a_passage(docs_of):
    header = "The members of the house met in the old hall on the first day of the month."
    footer = "All rights to this page and to what it shows stay with the house and its members."
    inner = ["unique row", "other unique", "third fact"]
    texts = [(1, f"{header}\n{footer}"), (2, "\n".join([header, *inner, footer])), (3, f"{header}\n***\n{footer}")]
    rows = sorted(tuple(r) for r in substring_dedup.repeated_passages(docs_of(texts)).select("doc_id", "start", "end", "n_units").collect())
    second = len("\n".join([header, *inner, ""]))
    marks = len(texts[2][1])
    assert rows == [(2, 0, len(header) + 1, 1), (2, second, len(texts[1][1]), 1), (3, 0, marks, 2)]


def test_short_units_are_parts_of_passages_and_reported_alone_on_request(docs_of):
    shouts = " ".join(f"W{k}!!" for k in range(30))
    texts = [(1, shouts), (2, f"A beginning of its own. {shouts}"), (3, "six words stand on this line\nelse"),
             (4, "six words stand on this line\nother")]
    rows = {r["doc_id"]: r for r in substring_dedup.repeated_passages(docs_of(texts)).collect()}
    assert set(rows) == {2} and rows[2]["n_units"] == 30 and texts[1][1][rows[2]["start"]:rows[2]["end"]].strip() == shouts
    every = substring_dedup.repeated_passages(docs_of(texts), passage_words=1).collect()
    assert {(r["doc_id"], r["n_words"], r["first_doc_id"]) for r in every} == {(2, 30, 1), (4, 6, 3)}


def test_text_without_blanks_is_counted_by_characters(docs_of):
    passage = "天地玄黄宇宙洪荒日月盈昃辰宿列张。寒来暑往秋收冬藏。"
    texts = [(1, f"{passage}甲乙。"), (2, f"丙丁。{passage}")]
    rows = substring_dedup.repeated_passages(docs_of(texts)).collect()
    assert [(r["doc_id"], r["n_units"], r["n_words"], texts[1][1][r["start"]:r["end"]]) for r in rows] == [(2, 2, 24, passage)]


def test_passages_odd_rows(odd, empty):
    rows = substring_dedup.repeated_passages(odd, passage_words=5).select("doc_id", "start", "end", "first_doc_id").collect()
    assert [tuple(r) for r in rows] == [(7, 0, len(ODD[3][1]), 4)]
    assert substring_dedup.repeated_passages(empty).count() == 0
