"""The pipeline and the registered queries."""

import pytest

import corpus_pipeline
from vitalis.llm import langid, line_dedup, minhash, mixing, packing, queries
from tests.llm.conftest import ODD


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(queries.QUERIES) <= set(names) and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's result on the smallest table, by name."""
    base, out = tmp_path_factory.mktemp("stages"), {}
    docs = out["documents"] = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(base / name))
        docs = out[name] = spark.read.parquet(str(base / name))
    return out


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_match_their_operators(stages):
    names = ["documents", *(n for n, _ in corpus_pipeline.STAGES)]
    for a in names[:-1]:
        assert stages[a].columns == stages["documents"].columns
    first, second, third, fourth, fifth = (stages[n] for n in names[:5])
    sure = {r["doc_id"] for r in langid.identify_language(first).collect() if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.MIN_LANGUAGE_SCORE}
    assert texts(second) == [t for t in texts(first) if t[0] in sure] and len(sure) > 190
    gone = {(r["doc_id"], r["line_no"]) for r in line_dedup.line_classes(second).where("not kept").collect()}
    want = []
    for i, t in texts(second):
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        if line_dedup.normal_form(left):
            want.append((i, left))
    assert texts(third) == sorted(want) and gone
    kept = {r["doc_id"] for r in minhash.near_duplicates(third).where("kept").collect()}
    assert texts(fourth) == [t for t in texts(third) if t[0] in kept]
    total = sum(r["taken"] for r in mixing.mix_report(fourth).collect())
    assert sum(len(t.split()) for _, t in texts(fifth)) == pytest.approx(total, rel=0.01)
    assert {i for i, _ in texts(fifth)} <= kept
    enc = packing.Encoder.load(packing.default_tokenizer())
    assert stages["pack"].agg({"length": "sum"}).first()[0] == sum(len(enc.ids(t)) + 1 for _, t in texts(fifth))


def test_near_copies_keep_one_document(spark, docs_of):
    words = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join(words[:50] + [f"x{k}"] + words[50:])) for k in range(5)] + [(9, " ".join(reversed(words)))]
    left = corpus_pipeline.near_duplicates(spark, docs_of(rows), "")
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 9]


def test_stages_on_odd_and_empty_tables(spark, odd, empty, docs_of):
    for table in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, table, "").collect()
    left = corpus_pipeline.near_duplicates(spark, odd, "").collect()
    assert sorted(str(r["doc_id"]) for r in left) == sorted({str(i) for i, _ in ODD if i != 7})


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 100
