"""Operators that score, mix or pack documents, against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitalis.llm import langid, lm, mixing, packing, quality, toxicity
from tests.llm.conftest import ODD


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def fold(i, mod):
    return None if i is None else zlib.crc32(str(i).encode()) % mod


# -- language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify_language(docs).collect()
    assert len(got) == len(lang) and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_language_ignores_labels_of_held_out_rows(spark, real):
    from pyspark.sql import functions as F
    docs = real("documents")
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit("xx")).otherwise(F.col("lang")))
    assert rows_of(langid.identify_language(docs)) == rows_of(langid.identify_language(changed))


def test_language_odd_rows(odd, empty, real):
    model = langid.fit(real("documents"))
    got = langid.identify_language(odd, model).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert all(by[i] == ("und", 0.0) for i in (1, 2, 3, 5)) and by[9][0] in model.langs
    assert langid.identify_language(empty).count() == 0
    assert {r["lang_pred"] for r in langid.identify_language(odd.where("doc_id = 1")).collect()} == {"und"}


def test_families_and_pairs():
    rng = np.random.default_rng(0)
    x = np.zeros((80, langid.BUCKETS))
    y = [["en", "de", "fr", "zz"][k % 4] for k in range(80)]
    for k in range(80):
        x[k, (k % 4) * 10:(k % 4) * 10 + 10] = rng.random(10)
    model = langid.TwoLevel(x / x.sum(1, keepdims=True), y, langid.FAMILIES)
    assert model.members == [["de", "en"], ["fr"], ["zz"]] and model.pairs == [("de", "en")]
    assert model.table.shape == (langid.BUCKETS, 4)


def test_long_text_is_read_whole(monkeypatch):
    text = "abcdefghij " * 500
    whole = langid.frequencies(text)
    monkeypatch.setattr(langid, "PIECE", 64)
    # Pieces share two code points, so only a bigram at each seam counts twice.
    assert np.abs(langid.frequencies(text) - whole).sum() < 0.02


# -- toxicity


def small_network(rng):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]
    texts = [[rng.choice(words) for _ in range(rng.randrange(5, 90))] for _ in range(60)]
    labels = np.array([k % 2 for k in range(60)], float)
    for t, y in zip(texts, labels):
        if y:
            t[rng.randrange(len(t))] = "vile"
    return texts, labels


def test_gradients_match_differences():
    rng = random.Random(0)
    texts, labels = small_network(rng)
    data = toxicity.Encoded({"alpha": 1, "vile": 2}, texts[:6])
    w = {k: v.astype(np.float64) for k, v in toxicity.start_weights(3, np.random.default_rng(1)).items()}
    rows = np.arange(min(7, len(data.at)))
    args = data.subset(rows)
    y, weight = labels[data.owner[rows]], np.full(len(rows), 0.2)
    _, g = toxicity.gradients(w, *args, y, weight)
    for name in w:
        flat = w[name].ravel()
        at = int(np.abs(g[name]).ravel().argmax())
        keep, step, loss = flat[at], 1e-2, []
        for by in (step, -step):
            flat[at] = keep + by
            loss.append(toxicity.gradients(w, *args, y, weight)[0])
        flat[at] = keep
        assert g[name].ravel()[at] == pytest.approx((loss[0] - loss[1]) / (2 * step), rel=0.05, abs=1e-4), name


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 64, 1000, 1001):
        spans = toxicity.windows(n)
        assert set().union(*(range(s, s + z) for s, z in spans.tolist())) == set(range(n))
        assert all(z <= toxicity.WIDTH for z in spans[:, 1]) and len({tuple(x) for x in spans.tolist()}) == len(spans)


def test_a_text_scores_as_its_highest_window():
    rng = random.Random(3)
    texts, labels = small_network(rng)
    cut = [" ".join(t[s:s + z]) for t in texts for s, z in toxicity.windows(len(t)).tolist()]
    owner = np.array([k for k, t in enumerate(texts) for _ in toxicity.windows(len(t))])
    net = toxicity.train(cut, owner, labels, 0.5, steps=60, min_docs=2)
    for t in texts[:10]:
        each = [float(net.text_logits([t[s:s + z]])[0]) for s, z in toxicity.windows(len(t)).tolist()]
        assert float(net.text_logits([t])[0]) == pytest.approx(max(each), abs=1e-4)


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    held = [i for i in truth if fold(i, 3) == 1]
    assert all(got[i]["held_out"] for i in held) and all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    bad, clean = [i for i in held if truth[i] == 1], [i for i in held if truth[i] == 0]
    assert sum(got[i]["predicted"] for i in bad) >= 0.7 * len(bad)
    assert sum(got[i]["predicted"] for i in clean) <= 0.03 * len(clean)


def test_toxicity_odd_rows(odd, empty, real):
    docs, labels = real("documents"), real("labels")
    net = toxicity.fit(docs, labels, steps=30)
    got = toxicity.score_toxicity(odd, labels, net).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1] == by[2] == by[3]
    assert toxicity.score_toxicity(empty, labels).count() == 0
    none = toxicity.score_toxicity(odd, labels.where("doc_id < 0")).collect()
    assert len({r["score"] for r in none}) == 1


# -- quality


def brute_rules(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    repeat = set()
    for k in range(len(words) - 4):
        if grams[tuple(words[k:k + 5])] > 1:
            repeat |= set(range(k, k + 5))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab# \n\t|é  ", max_size=120))
def test_rule_counts(text):
    assert quality.statistics(text)[:5] == brute_rules(text)


def test_quality_on_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    mark = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = {r["doc_id"]: r for r in quality.isolation_quality(docs, labels).collect()}
    assert len(got) == len(texts)
    for i, r in got.items():
        n, chars, symbols, dup, repeat = brute_rules(texts[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n) and r["kept"] == (not r["base_failed"] and r["anomaly"] < r["cut"])
    good = [i for i in mark if mark[i] == 1]
    bad = [i for i in mark if mark[i] == 0]
    assert sum(got[i]["kept"] for i in good) >= 0.93 * len(good) and sum(got[i]["kept"] for i in bad) <= 0.1 * len(bad)


def test_quality_odd_rows(odd, empty, real):
    got = quality.isolation_quality(odd, real("labels")).collect()
    assert len(got) == len(ODD) and all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] not in (4, 7))
    assert quality.isolation_quality(empty, real("labels")).count() == 0


def test_isolation_scores_outliers_higher():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 4))
    forest = quality.Forest(x)
    assert forest.score(np.full((1, 4), 6.0))[0] > forest.score(x).max() - 0.02 > forest.score(np.zeros((1, 4)))[0]
    # Path lengths by walking one row at a time.
    row, total = x[0], 0.0
    for feature, cut, left, right, path in forest.trees:
        k = 0
        while feature[k] >= 0:
            k = left[k] if row[feature[k]] < cut[k] else right[k]
        total += path[k]
    assert forest.score(x[:1])[0] == pytest.approx(2 ** (-(total / 100) / quality._average_path(256)))


def test_calibration_limits_the_loss():
    histogram = [(300, 1, 900), (500, 1, 90), (700, 1, 10), (650, 0, 50), (490, 0, 50)]
    assert quality.calibrate(histogram, 0.02, 0.6) == 0.65
    assert quality.calibrate(histogram, 0.2, 0.6) == 0.65 or quality.calibrate(histogram, 0.2, 0.6) == 0.49
    assert quality.calibrate(histogram[:3], 0.2, 0.6) == 0.6


# -- language model


def brute_model(texts, order, m):
    """Scores by the smoothing formula, word by word."""
    tokens = [((t or "").encode().lower().split() + [b" "]) for _, t in texts]
    count = [Counter() for _ in range(order + 1)]
    for (i, _), t in zip(texts, tokens):
        if fold(i, 7) != 2:
            stream = [b" ", *t]
            for k in range(1, order + 1):
                for at in range(1, len(stream)):
                    gram = tuple(stream[at - k + 1:at + 1]) if at - k + 1 >= 0 else ()
                    if len(gram) == k and (k == 1 or b" " not in gram[1:-1]):
                        count[k][gram] += 1
    n, v = sum(count[1].values()), len(count[1])

    def p(history, w):
        c = count[1][(w,)]
        if not history:
            return (c + 1) / (n + v + 1)
        lower = p(history[1:], w)
        h = count[len(history)][history]
        return (count[len(history) + 1][(*history, w)] + m * lower) / (h + m) if h else lower
    out = []
    for t in tokens:
        stream, total = [b" ", *t], 0.0
        for at in range(1, len(stream)):
            total += math.log10(p(tuple(stream[max(0, at - order + 1):at]), stream[at]))
        base = sum(math.log10((count[1][(w,)] + 1) / (n + 1 * (v + 1))) for w in t)
        out.append((len(t), sum(count[1][(w,)] > 0 for w in t), n, base, total))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_automaton_matches_the_formula(spark, docs_of, order):
    rng = random.Random(order)
    texts = [(k, " ".join(rng.choice("a b c d e A É".split()) + ("" if rng.random() < 0.9 else str(rng.randrange(60))) for _ in range(rng.randrange(0, 30)))
              + rng.choice(["", "\n", " z"])) for k in range(60)] + [(60, None), (61, ""), (None, "a b c")]
    want = Counter((i, fold(i, 7) == 2, *(round(x, 7) for x in r)) for (i, _), r in zip(texts, brute_model(texts, order, 3.0)))
    got = lm.score_language_model(docs_of(texts), order=order, strength=3.0, block_bytes=200, shard_tokens=100).collect()
    assert Counter(tuple(round(x, 7) if isinstance(x, float) else x for x in r) for r in got) == want


def test_model_beats_the_base_on_held_out_texts(spark):
    got = [r for r in lm.score_language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.95 * sum(r["base_score"] for r in got)


def test_counts_are_sent_in_few_bytes():
    for most, width in ((0, 1), (255, 1), (256, 2), (65_536, 4), (1 << 32, 8)):
        numbers = np.array([0, most, 3])
        data = lm.packed(numbers)
        assert len(data) == 3 * width and lm.unpacked(data, 3).tolist() == numbers.tolist()
    assert lm.packed(np.zeros(0, np.int64)) == b"" and lm.unpacked(b"", 0).tolist() == []


def test_automaton_probabilities_sum_to_one():
    rng = random.Random(0)
    words = [b" ", *(b"%d" % k for k in range(6))]
    codes = np.array([rng.choice([1, 2, 2, 3, 0]) for _ in range(80)] + [0])
    sizes = np.diff(np.append(-1, np.flatnonzero(codes == 0)))
    g = lm.Grams(words, np.append(codes, [4, 5, 6, 0]), np.append(sizes, 4), np.append(np.zeros(len(sizes), bool), True), 3)
    n, v = int(g.counts[0].sum()), int((g.counts[0] > 0).sum())
    auto = lm.Automaton(g, g.counts, n, v, 2.0)
    for state in range(len(auto.fail)):
        auto.start = state
        known = [w for w in range(7) if w < 4]
        total = sum(10 ** auto.score([w]) for w in known) + 10 ** auto.score([5])  # 5 stands for all unknown words
        assert total == pytest.approx(1.0)


def test_language_model_odd_rows(odd, empty):
    got = lm.score_language_model(odd).collect()
    assert len(got) == len(ODD) and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert next(r for r in got if r["doc_id"] == 6)["n_tokens"] == 60_001
    assert lm.score_language_model(empty).count() == 0


# -- packing


@pytest.fixture(scope="module")
def slow():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_tokenizer())


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab cé'sßñ12.\n\t   |<", max_size=80)))
def test_ids_are_those_of_the_library(text):
    enc = packing.Encoder.load(packing.default_tokenizer())
    assert enc.ids(text).tolist() == enc.slow.encode(text, add_special_tokens=False).ids


def test_special_token_text_is_left_to_the_library(slow):
    text = "before <|endoftext|> after"
    assert packing.Encoder.load(packing.default_tokenizer()).ids(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def check_packing(texts, rows, slow, window):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for i, some in pieces.items():
        mine = [np.array(slow.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for j, t in texts if j == i]
        left = Counter((k, at) for k, ids in enumerate(mine) for at in range(len(ids)))
        for r in some:
            # Rows that repeat an id: find the one that the piece is of.
            k = next(k for k, ids in enumerate(mine) if len(ids) == r["doc_tokens"] and left[(k, r["start"])]
                     and zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"])
            left.subtract((k, at) for at in range(r["start"], r["start"] + r["length"]))
        assert set(left.values()) == {0}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return {k: sum(n for _, n in s) for k, s in sequences.items()}


def test_packing_round_trip(real, slow):
    docs = real("documents")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = packing.retrieval_pack(docs).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in texts}
    filled = check_packing(texts, rows, slow, 1024)
    assert sum(n < 1024 for n in filled.values()) <= 1  # one shard


def test_packing_odd_rows(odd, empty, slow):
    rows = packing.retrieval_pack(odd, window=64, shard_docs=4).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in ODD}
    check_packing([(i, t) for i, t in ODD], rows, slow, 64)
    assert packing.retrieval_pack(empty).count() == 0


def test_bm25_matches_the_formula_and_neighbours_follow_the_seed():
    rng = random.Random(1)
    docs = [Counter(rng.randrange(40) for _ in range(rng.randrange(1, 30))) for _ in range(30)]
    idf = np.zeros(packing.TERMS)
    idf[:40] = [rng.random() + 0.1 for _ in range(40)]
    terms = [np.array([t | (n << packing.TERM_BITS) for t, n in d.items()], "<u4").tobytes() for d in docs]
    size = np.array([sum(d.values()) for d in docs], float)
    index = packing.Shard(terms, size, idf, size.mean())
    shared = {t for t in range(40) if sum(t in d for d in docs) > 1}
    for seed in range(30):
        want = [sum(idf[t] * d[t] * 2.2 / (d[t] + 1.2 * (0.25 + 0.75 * z / size.mean())) for t in docs[seed] if t in d and t in shared)
                for d, z in zip(docs, size)]
        assert index.scores(seed, 64) == pytest.approx(want)
    left = np.array([rng.randrange(1, 60) for _ in docs])
    used = np.zeros(30, int)
    for row in packing.fill(left, index, 64):
        for at, (d, take) in enumerate(row):
            assert 0 < take <= left[d] - used[d]
            if 0 < at:
                free = [k for k in range(30) if left[k] > used[k] and k not in [x for x, _ in row[:at]]]
                score = index.scores(row[0][0], 64)
                assert score[d] == max(score[free])
            used[d] += take
    assert (used == left).all()


def test_all_terms_of_a_seed_count():
    # Terms beyond a seed's weightiest 64, and terms of most documents, still order the neighbours.
    n = 200
    idf = np.zeros(packing.TERMS)
    idf[:n] = np.linspace(2.0, 1.0, n)
    docs = [range(n), range(100), range(40, 60), range(100, 200)]
    terms = [np.array([t | (1 << packing.TERM_BITS) for t in d], "<u4").tobytes() for d in docs]
    size = np.array([len(d) for d in docs], float)
    index = packing.Shard(terms, size, idf, 100.0)
    # The third document has the fewest terms in common, but all among the seed's weightiest.
    assert [d for d, _ in next(packing.fill(np.array([50, 10, 10, 10]), index, 80))] == [0, 1, 3, 2]
    for seed in range(4):
        want = [sum(idf[t] * 2.2 / (1 + 1.2 * (0.25 + 0.75 * z / 100.0)) for t in set(docs[seed]) & set(d) if sum(t in e for e in docs) > 1)
                for d, z in zip(docs, size)]
        assert index.scores(seed) == pytest.approx(want)


def test_a_term_of_most_documents_orders_neighbours(docs_of, slow):
    # " blue" is in a third of the documents, and all that the seed shares with them.
    seed = "red" + " blue" * 20 + " one two three four five six seven eight nine ten"
    other = ["table chair window door", "green grass", "cold rain", "a small house", "late trains", "old books here"]
    texts = [(1, seed), (2, "my blue blue"), (3, "a blue blue blue"), *((k + 4, t) for k, t in enumerate(other))]
    rows = packing.retrieval_pack(docs_of(texts), window=40).collect()
    check_packing(texts, rows, slow, 40)
    by = sorted((r["sequence_id"], r["offset"], r["doc_id"]) for r in rows)
    assert by[0][2] == 1 and by[1][0] == by[0][0] and by[1][2] in (2, 3)


# -- mixing


def test_targets():
    assert mixing.targets([10, 10, 10], [5, 2, 1]) == pytest.approx([18.75, 7.5, 3.75])
    assert mixing.targets([1, 100, 0], [5, 2, 1]) == pytest.approx([3, 98, 0])
    assert sum(mixing.targets([3, 7, 11, 2], [5, 2, 1, 5])) == pytest.approx(23)
    assert mixing.targets([], []) == []


def test_permutation_and_shard_draws():
    for n in (1, 2, 3, 7, 64, 100, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 9).tolist()) == list(range(n))
    slots = np.array([700, 0, 41, 259])
    at = np.zeros(4, int)
    for k in range(10):
        before, own = mixing.shard_counts(k, 10, 100, slots, 3)
        assert (before == at).all() and own.sum() == 100
        at += own
    assert (at == slots).all()


def brute_taken(rows, spans, plan):
    """Words taken of each row, by listing every slot."""
    stream = defaultdict(dict)
    for r in spans:
        for w in range(r["start"], r["start"] + r["size"]):
            assert w not in stream[r["sid"]]
            stream[r["sid"]][w] = r["row"]
    taken = Counter()
    for sid, n in enumerate(plan.slots.tolist()):
        assert set(stream[sid]) == set(range(plan.size[sid]))
        for slot in range(n):
            e, i = divmod(slot, plan.blocks[sid])
            block = int(mixing.permuted(np.array([i]), plan.blocks[sid], plan.seed * 1_000_003 + sid * 1009 + e * 17)[0])
            for w in range(block * plan.length[sid], min((block + 1) * plan.length[sid], plan.size[sid])):
                taken[stream[sid][w]] += 1
    return taken


def test_mix_matches_brute_force(spark, real):
    docs = real("documents")
    spans, _ = mixing.mix(docs)
    spans = spans.collect()
    sizes = [(r["source"], r["z"], r["n"]) for r in docs.selectExpr("source", "size(filter(split(text, '[ \\t-\\r]+'), x -> x != '')) as z")
             .groupBy("source").agg({"z": "sum", "*": "count"}).withColumnRenamed("sum(z)", "z").withColumnRenamed("count(1)", "n").collect()]
    plan = mixing.Plan(sizes, 32, 1 << 15, 20)
    taken = brute_taken(None, spans, plan)
    want = Counter((r["doc_id"], r["size"], taken[r["row"]]) for r in spans)
    got = mixing.mix_report(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == want
    assert sorted(got) == sorted(mixing.mix_report(docs, shard_slots=500).collect())  # sums don't depend on the shards
    total, source = defaultdict(int), {r["doc_id"]: r["source"] for r in docs.collect()}
    target = {}
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        total[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    for s in target:
        assert total[s] == pytest.approx(target[s], rel=0.03, abs=2)


def test_mix_odd_rows(docs_of, odd, empty):
    docs = docs_of([(k, "w " * (k % 9), "en", [None, "a", "é", "b"][k % 4]) for k in range(200)] + [(4, "w w w", "en", None)] * 3)
    got = mixing.mix_report(docs).collect()
    assert len(got) == 203 and all(r["taken"] <= 3 * r["size"] for r in got)
    total, target = Counter(), {}
    for r in got:
        total[r["doc_id"] % 4] += r["taken"]
        target[r["doc_id"] % 4] = r["target"]
    assert all(total[s] == pytest.approx(t, rel=0.05, abs=3) for s, t in target.items())
    assert len(mixing.mix_report(odd).collect()) == len(ODD) and mixing.mix_report(empty).count() == 0


def test_mixed_documents_have_the_words_that_were_taken(docs_of):
    rng = random.Random(2)
    texts = [(k, "  ".join(f"d{k}w{j}" for j in range(rng.randrange(0, 150))) + "\n", "en", f"s{k % 5}") for k in range(60)]
    docs = docs_of(texts)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_report(docs, row_col="doc_id").collect()}
    # Rows are numbered alike, so the two see the same streams.
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        mine = r["text"].split()
        words[r["doc_id"]] += len(mine)
        assert set(mine) <= set(texts[r["doc_id"]][1].split()) and len(set(mine)) == len(mine)
    assert {i: n for i, n in taken.items() if n} == dict(words)
