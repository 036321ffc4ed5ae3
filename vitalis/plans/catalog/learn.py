"""Feature engineering (2.9) and evaluation (2.11) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.operators import categories as CT
from vitalis.operators import evaluate as EV
from vitalis.operators import features as FE
from vitalis.plans.catalog.eda import eda
from vitalis.operators.quantiles import exact_quantiles
from vitalis.plans.registry import register
from vitalis.session import scratch
from vitalis.sources import fixtures as FX
from vitalis.sources.tables import table

TOK_ASCII = "regexp_extract_all(lower(text), '([A-Za-z0-9_]{2,})', 1)"
TOK_UNI = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+', 0)"
VOCAB_SQL = f"""
SELECT '<PAD>' AS token, 0 AS id UNION ALL SELECT '<UNK>', 1
UNION ALL SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 1 AS INT) FROM (
  SELECT token, count(*) AS cnt FROM (SELECT unnest({TOK_UNI}) AS token FROM documents) x GROUP BY token
  ORDER BY cnt DESC, token LIMIT 19998) t"""
VITALS = [r.clean for r in S.VITAL_RULES]


# --- 2.9 features -----------------------------------------------------------------

@register("feat_tfidf", [], f"""
WITH g AS (SELECT doc_id AS doc, CASE WHEN len(tk) >= 2
             THEN list_concat(tk, list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1])) ELSE tk END AS terms
           FROM (SELECT doc_id, {TOK_ASCII} AS tk FROM documents) t),
tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM g) x GROUP BY doc, term),
n AS (SELECT count(*) AS n FROM documents),
v AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term HAVING count(*) >= 2
      ORDER BY cf DESC, term ASC LIMIT 10000),
w AS (SELECT tf.doc, tf.term, tf.tf * (ln((1 + n.n) / (1 + v.df)) + 1) AS w FROM tf JOIN v USING (term), n)
SELECT doc AS doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc)), 6) AS weight FROM w""")
def q_feat_tfidf(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    tf = FE.doc_terms(docs, "doc_id", "text")
    model = FE.tfidf_fit(tf, docs)
    w = FE.tfidf_transform(tf, model)
    return w.select(F.col("doc").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@register("feat_vocabulary", [], VOCAB_SQL)
def q_feat_vocabulary(spark, sf):
    return FE.vocabulary(table(spark, sf, "documents"), "text")


@register("win_vocab_rank", [], VOCAB_SQL)
def q_win_vocab_rank(spark, sf):
    return FE.vocabulary(table(spark, sf, "documents"), "text")


@register("feat_encode_pad", [], f"""
WITH v AS ({VOCAB_SQL}),
tok AS (SELECT doc_id, unnest(tk[1:256]) AS token, generate_subscripts(tk[1:256], 1) AS pos
        FROM (SELECT doc_id, {TOK_UNI} AS tk FROM documents) d),
ids AS (SELECT doc_id, list(coalesce(v.id, 1) ORDER BY pos) AS ids FROM tok LEFT JOIN v USING (token) GROUP BY doc_id)
SELECT d.doc_id, list_resize(coalesce(ids.ids, []::INTEGER[]), 256, 0) AS token_ids
FROM documents d LEFT JOIN ids USING (doc_id)""")
def q_feat_encode_pad(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocab = FE.vocabulary(docs, "text")
    return FE.encode_pad(docs, "doc_id", "text", vocab, 256)


@register("join_vocabulary", [], f"""
WITH v AS ({VOCAB_SQL})
SELECT doc_id, pos, token, coalesce(v.id, 1) AS id FROM (
  SELECT doc_id, unnest(tk) AS token, generate_subscripts(tk, 1) - 1 AS pos
  FROM (SELECT doc_id, {TOK_UNI} AS tk FROM documents) d) t LEFT JOIN v USING (token)""")
def q_join_vocabulary(spark, sf):
    """Token -> id for every token position; unknown tokens map to id 1
    (the vocabulary is capped, so broadcasting it is safe)."""
    from vitalis.functions import text as X
    docs = table(spark, sf, "documents")
    vocab = FE.vocabulary(docs, "text")
    de = docs.select("doc_id", F.posexplode(
        X.tokenize("text", X.TOKEN_RE_UNICODE, 0)).alias("pos", "token"))
    return de.join(F.broadcast(vocab), "token", "left").select(
        "doc_id", "pos", "token", F.coalesce("id", F.lit(1)).alias("id"))


@register("feat_text_validate", [], """
SELECT count(*) AS rows, count(*) FILTER (WHERE text IS NULL) AS null_texts,
  count(*) FILTER (WHERE trim(text) = '') AS blank_texts FROM documents""")
def q_feat_text_validate(spark, sf):
    return FE.text_checks(table(spark, sf, "documents"), "text")


@register("feat_impute_median", ["eda"], "SELECT visit_row, " + ", ".join(
    f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM eda)) AS {c}" for c in VITALS) + " FROM eda")
def q_feat_impute_median(spark, sf):
    e = eda(spark, sf).select("visit_row", *VITALS)
    return FE.impute_median(e, VITALS)


@register("feat_minmax", [], """
SELECT p_partkey, CASE WHEN max(p_size) OVER () > min(p_size) OVER ()
    THEN round((p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()), 6) ELSE 0 END AS p_size,
  CASE WHEN max(p_retailprice) OVER () > min(p_retailprice) OVER ()
    THEN round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()), 6)
    ELSE 0 END AS p_retailprice
FROM part""")
def q_feat_minmax(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    cols = ["p_size", "p_retailprice"]
    out = FE.minmax_apply(p, cols, FE.minmax_fit(p, cols), keep=["p_partkey"])
    return out.select("p_partkey", *[F.round(c, 6).alias(c) for c in cols])


@register("feat_impute_mode", ["eda"], """
SELECT visit_row, coalesce(DIAG1_description, (SELECT DIAG1_description FROM eda WHERE DIAG1_description IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS DIAG1_description FROM eda""")
def q_feat_impute_mode(spark, sf):
    e = eda(spark, sf).select("visit_row", "DIAG1_description")
    return FE.impute_mode(e, "DIAG1_description")


@register("feat_onehot", [], "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{c}' AS INT) AS cat__c_mktsegment_{c}"
    for c in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer")
def q_feat_onehot(spark, sf):
    c = table(spark, sf, "customer")
    return FE.onehot(c, "c_mktsegment", FE.categories(c, "c_mktsegment"), keep=["c_custkey"])


@register("feat_onehot_sparse", [], """
WITH d AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS id
           FROM (SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS v FROM orders WHERE o_orderstatus = 'F'))
SELECT o_orderkey, (SELECT count(*) FROM d) AS n_categories, id AS hot
FROM orders LEFT JOIN d ON v = 'C' || CAST(o_custkey AS VARCHAR)""")
def q_feat_onehot_sparse(spark, sf):
    """One category for each customer with a finished order, coded on all
    orders: the length of the sparse vector and the place of its 1 (null for
    a customer that wasn't learnt)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer"))
    out = CT.SparseOneHot(["customer"]).fit(o.where("o_orderstatus = 'F'")).transform(o)
    v = F.unwrap_udt("cat__customer")
    return out.select("o_orderkey", v["size"].alias("n_categories"), F.get(v["indices"], F.lit(0)).alias("hot"))


@register("feat_binary_passthrough", [], """
SELECT doc_id, quality AS bin__quality, toxic AS bin__toxic,
  round((doc_id - min(doc_id) OVER ()) / (max(doc_id) OVER () - min(doc_id) OVER ()), 6) AS num__doc_id FROM labels""")
def q_feat_binary_passthrough(spark, sf):
    lab = table(spark, sf, "labels").withColumn("_id", F.col("doc_id").cast("double"))
    prep = FE.TabularPreprocessor(binary=["quality", "toxic"], numeric=["_id"], keys=["doc_id"]).fit(lab)
    out = prep.transform(lab)
    return out.select("doc_id", "bin__quality", "bin__toxic", F.round("num___id", 6).alias("num__doc_id"))


@register("feat_fit_prepare", [], """
SELECT c_custkey,
  round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS num__c_acctbal,
  CAST(c_mktsegment = 'AUTOMOBILE' AS INT) AS cat__c_mktsegment_AUTOMOBILE,
  CAST(c_mktsegment = 'BUILDING' AS INT) AS cat__c_mktsegment_BUILDING,
  CAST(c_mktsegment = 'FURNITURE' AS INT) AS cat__c_mktsegment_FURNITURE,
  CAST(c_mktsegment = 'HOUSEHOLD' AS INT) AS cat__c_mktsegment_HOUSEHOLD,
  CAST(c_mktsegment = 'MACHINERY' AS INT) AS cat__c_mktsegment_MACHINERY FROM customer""")
def q_feat_fit_prepare(spark, sf):
    c = table(spark, sf, "customer")
    prep = FE.TabularPreprocessor(numeric=["c_acctbal"], categorical=["c_mktsegment"], keys=["c_custkey"]).fit(c)
    out = prep.transform(c)
    return out.withColumn("num__c_acctbal", F.round("num__c_acctbal", 6))


@register("udf_transformer", [], "SELECT doc_id, " + ", ".join(
    f"CAST(coalesce(lang, '') = '{c}' AS INT) AS cat__lang_{c}" for c in ("de", "es", "fr")) + " FROM documents")
def q_udf_transformer(spark, sf):
    """Custom fit/transform stage storing categories: fitted on the documents
    that aren't English, saved, loaded and applied to all (an unknown
    language -> all zeros)."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    path = scratch(spark, "preprocessor")
    FE.TabularPreprocessor(categorical=["lang"], keys=["doc_id"]).fit(d.where(F.col("lang") != "en")).write().save(path)
    return FE.TabularPreprocessorModel.load(path).transform(d)


@register("feat_class_weight", [], """
SELECT quality, count(*) AS n_c, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM labels GROUP BY quality""")
def q_feat_class_weight(spark, sf):
    w = FE.class_weights(table(spark, sf, "labels"), "quality")
    return w.withColumn("weight", F.round("weight", 6))


@register("feat_label_index", ["eda"], """
SELECT target, CAST(dense_rank() OVER (ORDER BY target) - 1 AS INT) AS label_id FROM (SELECT DISTINCT target FROM eda) t""")
def q_feat_label_index(spark, sf):
    return FE.label_index(eda(spark, sf), "target").withColumn("label_id", F.col("label_id").cast("int"))


# --- 2.11 evaluation ------------------------------------------------------------------

def global_sql(view: str) -> str:
    return f"""
WITH cm AS (SELECT y_true AS y, y_pred AS p, count(*) AS n FROM {view} GROUP BY 1, 2),
t AS (SELECT y AS label, sum(n) AS support, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM cm GROUP BY y),
pr AS (SELECT p AS label, sum(n) AS predicted FROM cm GROUP BY p),
s AS (SELECT coalesce(t.label, pr.label) AS label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
        coalesce(predicted, 0) AS predicted FROM t FULL OUTER JOIN pr ON t.label = pr.label),
c AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS prec,
        CASE WHEN support > 0 THEN tp / support ELSE 0 END AS rec,
        CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1 FROM s),
a AS (SELECT sum(tp) / sum(support) AS accuracy, avg(prec) AS pm, avg(rec) AS rm, avg(f1) AS fm,
        sum(prec * support) / sum(support) AS pw, sum(rec * support) / sum(support) AS rw,
        sum(f1 * support) / sum(support) AS fw, count(*) FILTER (WHERE support > 0) AS k,
        max(label) FILTER (WHERE support > 0) AS pos FROM c)
SELECT round(accuracy, 6) AS accuracy,
  round(CASE WHEN k = 2 THEN c.prec ELSE pm END, 6) AS precision,
  round(CASE WHEN k = 2 THEN c.rec ELSE rm END, 6) AS recall,
  round(CASE WHEN k = 2 THEN c.f1 ELSE fm END, 6) AS f1,
  round(pm, 6) AS precision_macro, round(rm, 6) AS recall_macro, round(fm, 6) AS f1_macro,
  round(pw, 6) AS precision_weighted, round(rw, 6) AS recall_weighted, round(fw, 6) AS f1_weighted
FROM a LEFT JOIN c ON c.label = a.pos"""


@register("eval_global", ["scored"], global_sql("scored"))
def q_eval_global(spark, sf):
    return EV.global_metrics(FX.scored(spark, sf))


@register("eval_global_multiclass", ["scored_mc"], global_sql("scored_mc"))
def q_eval_global_multiclass(spark, sf):
    return EV.global_metrics(FX.scored_mc(spark, sf))


@register("eval_confusion", ["scored_mc"], """
SELECT y_true, y_pred, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY y_true), 6) AS rate
FROM scored_mc GROUP BY 1, 2""")
def q_eval_confusion(spark, sf):
    return EV.confusion_normalized(FX.scored_mc(spark, sf))


@register("eval_by_class", ["scored_mc"], """
WITH cm AS (SELECT y_true AS y, y_pred AS p, count(*) AS n FROM scored_mc GROUP BY 1, 2),
t AS (SELECT y AS label, sum(n) AS support, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM cm GROUP BY y),
pr AS (SELECT p AS label, sum(n) AS predicted FROM cm GROUP BY p)
SELECT t.label AS class, round(CASE WHEN coalesce(predicted, 0) > 0 THEN tp / predicted ELSE 0 END, 6) AS precision,
  round(tp / support, 6) AS recall, round(2 * tp / (support + coalesce(predicted, 0)), 6) AS f1,
  CAST(support AS BIGINT) AS support
FROM t LEFT JOIN pr ON pr.label = t.label""")
def q_eval_by_class(spark, sf):
    return EV.by_class(FX.scored_mc(spark, sf))


@register("eval_auc_binary", ["scored"], """
WITH h AS (SELECT score AS s, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true <> 1) AS neg
           FROM scored GROUP BY score),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c""")
def q_eval_auc_binary(spark, sf):
    return EV.auc_binary(FX.scored(spark, sf))


@register("eval_auc_ovr", [], """
WITH p AS (SELECT vec_id, label, [exp(CAST(x AS DOUBLE)) FOR x IN embedding[1:10]] AS e FROM embeddings),
q AS (SELECT vec_id, label, c, e[c + 1] / list_sum(e) AS s FROM (SELECT *, unnest(range(10)) AS c FROM p) u),
h AS (SELECT c, s, count(*) FILTER (WHERE label = c) AS pos, count(*) FILTER (WHERE label <> c) AS neg FROM q GROUP BY c, s),
b AS (SELECT c, pos, neg, coalesce(sum(neg) OVER (PARTITION BY c ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS below FROM h),
a AS (SELECT c, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM b GROUP BY c HAVING sum(pos) > 0)
SELECT round(avg(round(auc, 6)), 6) AS roc_auc_ovr, count(*) AS classes FROM a""")
def q_eval_auc_ovr(spark, sf):
    e = table(spark, sf, "embeddings")
    # Softmax over the first ten components, written out per component (no
    # lambda functions, whose fresh variable ids would keep the two uses
    # of the histogram below from sharing one exchange).
    exps = [F.exp(F.element_at("embedding", i + 1).cast("double")) for i in range(10)]
    p = e.select("label", F.array(*exps).alias("e"), sum(exps[1:], exps[0]).alias("t"))
    q = p.select("label", F.posexplode("e").alias("c", "v"), "t")
    hist = q.groupBy("c", (F.col("v") / F.col("t")).alias("s")).agg(
        F.count_if(F.col("label") == F.col("c")).alias("pos"), F.count_if(F.col("label") != F.col("c")).alias("neg"))
    per = EV.auc_from_hist(hist, keys=["c"]).where(F.col("roc_auc").isNotNull())
    return per.agg(F.round(F.avg("roc_auc"), 6).alias("roc_auc_ovr"), F.count(F.lit(1)).alias("classes"))


MAJ_SQL = """
WITH m AS (SELECT RFV1_description, target AS maj FROM (
    SELECT RFV1_description, target, row_number() OVER (PARTITION BY RFV1_description ORDER BY count(*) DESC, target) AS rn
    FROM eda WHERE RFV1_description IS NOT NULL GROUP BY 1, 2) x WHERE rn = 1),
g AS (SELECT target AS gmaj FROM eda GROUP BY target ORDER BY count(*) DESC, target LIMIT 1),
pred AS (SELECT e.target AS y_true, coalesce(m.maj, g.gmaj) AS y_pred FROM eda e LEFT JOIN m USING (RFV1_description), g)
"""


@register("eval_urgent_recall", ["eda"], MAJ_SQL + """
SELECT round(count(*) FILTER (WHERE y_true = 'urgente' AND y_pred = 'urgente') / count(*) FILTER (WHERE y_true = 'urgente'), 6)
  AS urgent_recall FROM pred""")
def q_eval_urgent_recall(spark, sf):
    from vitalis.operators.models import majority_rule_predictions
    pred = majority_rule_predictions(eda(spark, sf), "RFV1_description", "target")
    bc = EV.by_class(pred, "y_true", "y_pred")
    return bc.where(F.col("class") == "urgente").select(F.col("recall").alias("urgent_recall"))


@register("eval_latency", [], """
SELECT event_type, count(*) AS runs, round(quantile_cont(value, 0.5), 6) AS median_ms,
  round(quantile_cont(value, 0.95), 6) AS p95_ms, round(sum(value) / count(*), 6) AS ms_per_row
FROM events GROUP BY event_type""")
def q_eval_latency(spark, sf):
    ev = table(spark, sf, "events")
    q = exact_quantiles(ev, ["event_type"], "value", [0.5, 0.95]).select(
        F.col("event_type").alias("_t"), F.round("q0", 6).alias("median_ms"), F.round("q1", 6).alias("p95_ms"))
    runs = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("runs"),
                                        F.round(F.sum("value") / F.count(F.lit(1)), 6).alias("ms_per_row"))
    return (runs.join(q, runs["event_type"].eqNullSafe(q["_t"]), "left")
            .select("event_type", "runs", "median_ms", "p95_ms", "ms_per_row"))
