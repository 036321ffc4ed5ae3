"""Feature edge cases the driver tables do not contain: token-less and
missing documents in encode/pad, tokens beyond the length cap, and the
text-logistic tokenizer stage against the regex contract."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalis.operators import features as FE
from vitalis.operators import models as M


def test_encode_pad_keeps_tokenless_and_null_documents(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, "   "), (3, None), (4, "c " * 6)], "doc_id long, text string")
    vocab = FE.vocabulary(docs, "text")
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    assert ids["<PAD>"] == 0 and ids["<UNK>"] == 1
    out = {r["doc_id"]: r["token_ids"] for r in FE.encode_pad(docs, "doc_id", "text", vocab, max_len=4).collect()}
    assert out[1] == [ids["b"], ids["a"], ids["b"], 0]
    assert out[2] == [0, 0, 0, 0]
    assert out[3] == [0, 0, 0, 0]
    assert out[4] == [ids["c"]] * 4


def test_unknown_tokens_map_to_one(spark):
    train = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    other = spark.createDataFrame([(7, "alpha gamma")], "doc_id long, text string")
    vocab = FE.vocabulary(train, "text")
    row = FE.encode_pad(other, "doc_id", "text", vocab, max_len=3).first()
    assert row["token_ids"][1] == 1 and row["token_ids"][2] == 0


def test_text_stage_terms_are_tokens_then_bigrams(spark):
    df = spark.createDataFrame([("Ab, c DE-f9  x_y",), ("one",), ("",)], "clinical_text string")
    (stage,) = M.text_features()
    rows = [r["_terms"] for r in stage.transform(df).collect()]
    # tokens: 2+ of [A-Za-z0-9_] after lower-casing; one-letter runs dropped
    assert rows[0] == ["ab", "de", "f9", "x_y", "ab de", "de f9", "f9 x_y"]
    assert rows[1] == ["one"]
    assert rows[2] == []


def test_logistic_vocabulary_cap_breaks_ties_by_term(spark):
    # cf: aa 4; zz, mm, bb 2 each (tied); cc 1 (below min_df with df 1)
    rows = [("aa zz mm", "normal", "train"), ("aa bb zz", "urgente", "train"),
            ("aa mm bb", "atencao", "train"), ("aa cc", "normal", "train")]
    df = spark.createDataFrame(rows, "clinical_text string, target string, split string")
    model = M.fit_text_logistic(df, max_iter=5, min_df=2, vocab=3)
    cv = next(s for s in model.stages if hasattr(s, "vocabulary"))
    assert cv.vocabulary == ["aa", "bb", "mm"]


def test_tfidf_merges_rows_of_an_id_and_moves_no_other_tokens(spark):
    rows = [(1, "Red ring red"), (2, "red gear"), (2, "ring gear"), (None, "gear red"), (None, "ring"), (3, None), (4, "x"), (5, "gear red ring"), (2, "red gear")]
    want, n = {}, len(rows)
    terms = {}
    for i, text in rows:
        t = [x for x in (text or "").lower().split() if len(x) > 1]
        terms.setdefault(i, Counter()).update(t + [" ".join(p) for p in zip(t, t[1:])])
    df, cf = Counter(t for c in terms.values() for t in c), sum(terms.values(), Counter())
    top = sorted((t for t in df if df[t] >= 2), key=lambda t: (-cf[t], t))[:5]
    for i, c in terms.items():
        w = {t: c[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in top if t in c}
        want |= {(i, t): v / math.sqrt(sum(x * x for x in w.values())) for t, v in w.items()}
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    tf = FE.doc_terms(docs, "doc_id", "text")
    got = {(r["doc"], r["term"]): r["weight"] for r in FE.tfidf_transform(tf, FE.tfidf_fit(tf, docs, max_features=5)).collect()}
    assert got == pytest.approx(want) and len(want) > 8
    once = docs.where("doc_id in (1, 4, 5)").coalesce(2).withColumn("doc_id", F.col("doc_id").cast("string"))
    tf = FE.doc_terms(once, "doc_id", "text")
    assert tf.several is None
    out = FE.tfidf_transform(tf, FE.tfidf_fit(tf, once))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc" not in plan and "Window" not in plan  # documents are weighed where they are read
    assert {r["doc"] for r in out.collect()} == {"1", "5"}
