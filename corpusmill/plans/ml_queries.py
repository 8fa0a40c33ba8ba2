"""Model, similarity and clustering queries."""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from corpusmill.operators import cluster as C
from corpusmill.operators import features as FE
from corpusmill.operators import kernels as KN
from corpusmill.operators import models as M
from corpusmill.operators import sparse as SP
from corpusmill.operators import stats as ST
from corpusmill.plans.feature_queries import TERM_COUNTS_SQL
from corpusmill.plans.registry import register
from corpusmill.session import discard, small_side, stored
from corpusmill.sources.tables import table

SPLIT_SQL = "('0x' || substr(md5('42:' || CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 1000 < 800"
#: Rows that each tree of the forest is fitted on (the documented bound of that fit).
ROWS_PER_TREE = 1000.0
EPS_COS = 0.3  # cosine threshold for the embedding neighbourhoods (eps = sqrt(1.4))


def _docs_quality(spark, sf):
    """Labelled documents split 80/20 by key hash."""
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    d = d.select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    return FE.split(d, "doc_id", 0.8, 42)


def _docs_lang(spark, sf):
    d = M.index_labels(table(spark, sf, "documents").select("doc_id", "text", "lang"), "lang")
    return FE.split(d, "doc_id", 0.8, 42)


def _lines(spark, sf):
    """Tabular features of line items with the return flag as class."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    li = li.withColumn("row_key", F.concat_ws(":", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))
    li = M.index_labels(li, "l_returnflag")
    return FE.split(li, "row_key", 0.8, 42)


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _train_test(df):
    return df.filter("is_train"), df.filter(~F.col("is_train"))


def _text_pred(spark, sf, kind, data=_docs_quality, vocab=False, **kw):
    tr, te = _train_test(data(spark, sf))
    return M.fit_predict(tr, te, M.text_stages(vocab=vocab), M.classifier(kind, **kw), ["doc_id", "label"])


@register("nb_complement")
def q_nb_complement(spark, sf):
    return _text_pred(spark, sf, "complement", data=_docs_lang)


@register("nb_multinomial")
def q_nb_multinomial(spark, sf):
    return _text_pred(spark, sf, "multinomial", data=_docs_lang)


@register("nb_bernoulli")
def q_nb_bernoulli(spark, sf):
    tr, te = _train_test(_docs_lang(spark, sf))
    st = M.text_stages(idf=False)
    from pyspark.ml.feature import Binarizer  # 0/1 term presence for Bernoulli NB

    st[-1] = Binarizer(inputCol="_tf", outputCol="features", threshold=0.0)
    return M.fit_predict(tr, te, st, M.classifier("bernoulli"), ["doc_id", "label"])


@register("nb_gaussian")
def q_nb_gaussian(spark, sf):
    tr, te = _train_test(_lines(spark, sf))
    return M.fit_predict(tr, te, M.tabular_stages(LINE_FEATURES), M.classifier("gaussian"), ["row_key", "label"])


@register("linear_ovr")
def q_linear_ovr(spark, sf):
    return _text_pred(spark, sf, "linear_ovr", data=_docs_lang)


@register("dt_gini")
def q_dt_gini(spark, sf):
    tr, te = _train_test(_lines(spark, sf))
    return M.fit_predict(tr, te, M.tabular_stages(LINE_FEATURES), M.classifier("dt_gini"), ["row_key", "label"])


@register("dt_entropy")
def q_dt_entropy(spark, sf):
    tr, te = _train_test(_lines(spark, sf))
    return M.fit_predict(tr, te, M.tabular_stages(LINE_FEATURES), M.classifier("dt_entropy"), ["row_key", "label"])


@register("rf")
def q_rf(spark, sf):
    tr, te = _train_test(_lines(spark, sf))
    est = M.classifier("rf", numTrees=15, impurity="gini", subsamplingRate=min(1.0, ROWS_PER_TREE / max(tr.count(), 1)))
    return M.fit_predict(tr, te, M.tabular_stages(LINE_FEATURES), est, ["row_key", "label"])


@register("mlp")
def q_mlp(spark, sf):
    # stored once: the scaler's pass, the network's and the scoring do not hash and label the rows again
    tr, te = _train_test(stored(_lines(spark, sf).select("row_key", "label", "is_train", *LINE_FEATURES), "lines"))
    est = M.classifier("mlp", layers=[len(LINE_FEATURES), 32, 16, len(M.class_names(tr))], maxIter=20)
    return M.fit_predict(tr, te, M.tabular_stages(LINE_FEATURES, scale=True), est, ["row_key", "label"])


@register("svm_rbf")
def q_svm_rbf(spark, sf):
    from pyspark.ml.classification import LinearSVC

    e = table(spark, sf, "embeddings").select("vec_id", "embedding",
                                              (F.col("label") % 2).cast("double").alias("label"))
    e = FE.split(e, "vec_id", 0.8, 42)
    z = M.rbf_features(e.withColumn("features", F.col("embedding").cast("array<double>")), "features", dim=128,
                       n_in=64)
    tr, te = _train_test(z)
    m = LinearSVC(regParam=1e-3, maxIter=50).fit(tr)
    return m.transform(te).select("vec_id", "label", F.col("prediction").cast("double").alias("prediction"))


@register("svm_text")
def q_svm_text(spark, sf):
    """M7 on text: language of the held-out documents by RBF machines, one against the rest, on TF-IDF rows."""
    from pyspark.ml.classification import LinearSVC

    docs = _docs_lang(spark, sf)
    counts = FE.term_counts(docs.select("doc_id", "text"), packed=True)
    ids = docs.select("doc_id", "label", "is_train")
    again = small_side(ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"))  # a repeated id counts each time
    times = F.when(F.col("is_train"), F.coalesce("rows", F.lit(1))).otherwise(0)
    rows = FE.split(counts, "doc_id", 0.8, 42).join(again, "doc_id", "left").select("doc_id", "term", "n", times.alias("times"))
    weights = FE.tfidf_fitted(rows, "times")
    tr, te = _train_test(KN.rbf_rows(ids, weights))
    discard(counts)
    m = M.one_vs_rest(tr, LinearSVC(regParam=1e-3, maxIter=20))
    return m.transform(te).select("doc_id", "label", F.col("prediction").cast("double").alias("prediction"))


@register("calibrated")
def q_calibrated(spark, sf):
    rows, stages = M.prepared(_docs_lang(spark, sf), M.text_stages(), ["doc_id", "label", "is_train"])
    tr, te = _train_test(rows)
    model = Pipeline(stages=[*stages, M.classifier("linear_ovr")]).fit(tr)
    _, score = M.calibrate(model.transform(tr), "label", n_classes=len(M.class_names(tr)))
    out = score(model.transform(te))
    return out.select("doc_id", "label", "prediction", "probs", F.aggregate("probs", F.lit(0.0),
                                                                         lambda a, x: a + x).alias("prob_sum"))


@register("cv_scores")
def q_cv_scores(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    keys = table(spark, sf, "labels").join(docs.select("doc_id"), "doc_id").select("doc_id", F.col("quality").cast("double").alias("label"))
    d = docs.join(FE.stratified_folds(keys, "label", "doc_id", 5), "doc_id")  # folds are dealt out by key; texts join them
    return M.cross_validate(d, M.text_stages(), M.classifier("complement"), "label", "fold", 5)


@register("score_docs")
def q_score_docs(spark, sf):
    """Fit, save, reload and score; label rendered and probability of the
    predicted class picked by its index (Q15)."""
    import uuid

    from pyspark.ml.feature import IndexToString

    from corpusmill.session import ensure_checkpoint_dir

    tr, te = _train_test(_docs_lang(spark, sf))
    model = Pipeline(stages=[*M.text_stages(), M.classifier("multinomial")]).fit(tr)
    path = f"{ensure_checkpoint_dir(spark)}/models/score_docs-{uuid.uuid4().hex}"
    M.save_model(model, path)
    loaded = M.load_model(path)
    pred = loaded.transform(te)
    pred = IndexToString(inputCol="prediction", outputCol="predicted_lang", labels=M.class_names(tr)).transform(pred)
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("probability")
    return pred.select("doc_id", "lang", "predicted_lang",
                       F.round(p[F.col("prediction").cast("int")], 6).alias("probability"))


@register("model_table")
def q_model_table(spark, sf):
    """Accuracy per model on the same split."""
    rows, stages = M.prepared(_lines(spark, sf), M.tabular_stages(LINE_FEATURES), ["label", "is_train"])
    tr, te = _train_test(rows)
    out = None
    for name in ("dt_gini", "dt_entropy", "gaussian"):
        pred = M.fit_predict(tr, te, stages, M.classifier(name), ["label"])
        row = M.accuracy_table(pred, "label", name)
        out = row if out is None else out.unionByName(row)
    return out


# J11 / M6 ------------------------------------------------------------------------
def _emb(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    return FE.split(e, "vec_id", 0.8, 42)


KNN_SQL = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, {SPLIT_SQL.format(k='vec_id')} AS tr
    FROM embeddings),
    p AS (SELECT q.vec_id AS qid, b.vec_id AS bid, round(list_distance(q.v, b.v), 9) AS dist
          FROM e q JOIN e b ON NOT q.tr AND b.tr),
    r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, bid) AS rank FROM p)"""


@register("knn_labels", KNN_SQL + " SELECT qid, CAST(rank AS BIGINT) AS rank, bid, dist FROM r WHERE rank <= 10")
def q_knn_labels(spark, sf):
    e = _emb(spark, sf)
    q = e.filter(~F.col("is_train")).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    b = e.filter("is_train").select(F.col("vec_id").alias("bid"), F.col("embedding").alias("vec"))
    return C.knn(q, b, 10, "qid", "bid", "vec")


@register(
    "knn_predict",
    KNN_SQL + """, v AS (SELECT r.qid, e.label, count(*) AS votes FROM r JOIN e ON e.vec_id = r.bid WHERE rank <= 10
                 GROUP BY r.qid, e.label)
    SELECT qid, arg_min(label, (-votes, label)) AS prediction FROM v GROUP BY qid""",
)
def q_knn_predict(spark, sf):
    e = _emb(spark, sf)
    q = e.filter(~F.col("is_train")).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    b = e.filter("is_train").select(F.col("vec_id").alias("bid"), F.col("embedding").alias("vec"))
    nb = C.knn(q, b, 10, "qid", "bid", "vec")
    return C.knn_vote(nb, b.join(e.select(F.col("vec_id").alias("bid"), "label"), "bid"), "qid", "bid")


# J12 / M16 ------------------------------------------------------------------------
EPS_SQL = f"""WITH u AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(
        list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda y: y * y)))) AS v FROM embeddings),
    pr AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v), 6) AS cos FROM u a JOIN u b
           ON a.vec_id < b.vec_id WHERE round(list_dot_product(a.v, b.v), 6) >= {EPS_COS})"""


@register("eps_pairs", EPS_SQL + " SELECT a, b, cos FROM pr")
def q_eps_pairs(spark, sf):
    return C.eps_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", EPS_COS)


@register(
    "dbscan_core",
    EPS_SQL + """, both_ AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr),
    deg AS (SELECT a, count(*) AS d FROM both_ GROUP BY a)
    SELECT vec_id, (coalesce(d, 0) + 1 >= 5) AS core FROM embeddings LEFT JOIN deg ON deg.a = vec_id""",
)
def q_dbscan_core(spark, sf):
    emb = table(spark, sf, "embeddings")
    return C.core_points(emb, C.eps_pairs(emb, "vec_id", "embedding", EPS_COS), "vec_id", 5)


@register(
    "dbscan",
    EPS_SQL.replace("WITH u AS", "WITH RECURSIVE u AS") + """, both_ AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr),
    core AS (SELECT vec_id FROM embeddings LEFT JOIN (SELECT a, count(*) AS d FROM both_ GROUP BY a) g ON g.a = vec_id
             WHERE coalesce(d, 0) + 1 >= 5),
    ce AS (SELECT a, b FROM both_ WHERE a IN (SELECT vec_id FROM core) AND b IN (SELECT vec_id FROM core)),
    reach(id, lab) AS (SELECT vec_id, vec_id FROM core UNION SELECT ce.b, reach.lab FROM reach JOIN ce ON ce.a = reach.id),
    lab AS (SELECT id, min(lab) AS lab FROM reach GROUP BY id),
    border AS (SELECT both_.a, min(lab.lab) AS bl FROM both_ JOIN lab ON lab.id = both_.b GROUP BY both_.a)
    SELECT vec_id, CAST(coalesce(lab.lab, bl, -1) AS BIGINT) AS cluster, lab.lab IS NOT NULL AS core
    FROM embeddings LEFT JOIN lab ON lab.id = vec_id LEFT JOIN border ON border.a = vec_id""",
)
def q_dbscan(spark, sf):
    return C.dbscan(table(spark, sf, "embeddings"), "vec_id", "embedding", EPS_COS, 5)


# J12 / M16 on text --------------------------------------------------------------
TEXT_COS = 0.875  # unit vectors within a Euclidean distance of 0.5
TEXT_SQL = f"""c AS ({TERM_COUNTS_SQL}), nd AS (SELECT count(DISTINCT doc_id) AS n FROM c),
    df AS (SELECT term, count(*) AS df FROM c GROUP BY term),
    w AS (SELECT doc_id, term, n * (ln((1 + (SELECT n FROM nd)) / (1 + df)) + 1) AS w FROM c JOIN df USING (term)),
    nr AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
    v AS (SELECT doc_id, term, w / norm AS w FROM w JOIN nr USING (doc_id)),
    pr AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, sum(x.w * y.w) AS cos FROM v x JOIN v y
           ON x.term = y.term AND x.doc_id < y.doc_id GROUP BY 1, 2) WHERE round(cos, 6) >= {TEXT_COS}),
    both_ AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr)"""


def _text_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counts = FE.term_counts(docs, packed=True)
    members, pairs = SP.cosine_join(FE.tfidf_raw(counts), "doc_id", TEXT_COS)
    discard(counts)
    return docs, members, pairs


@register(
    "text_links",
    "WITH " + TEXT_SQL + """, sig AS (SELECT doc_id, md5(string_agg(term || ':' || CAST(n AS VARCHAR), ' ' ORDER BY term)) AS s FROM c GROUP BY doc_id),
    rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS rep FROM sig),
    deg AS (SELECT a, count(*) AS links FROM both_ GROUP BY a)
    SELECT doc_id, rep, coalesce(links, 0) AS links FROM documents LEFT JOIN rep USING (doc_id) LEFT JOIN deg ON a = doc_id""",
)
def q_text_links(spark, sf):
    """Every document's class of equal TF-IDF vectors and its number of similar documents."""
    docs, members, pairs = _text_join(spark, sf)
    return SP.links(docs, "doc_id", members, pairs)


@register(
    "dbscan_text",
    "WITH RECURSIVE " + TEXT_SQL + """, blank AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM c)),
    deg AS (SELECT a, count(*) AS d FROM both_ GROUP BY a),
    core AS (SELECT doc_id FROM documents LEFT JOIN deg ON a = doc_id
             WHERE CASE WHEN doc_id IN (SELECT doc_id FROM blank) THEN (SELECT count(*) FROM blank) ELSE coalesce(d, 0) + 1 END >= 5),
    ce AS (SELECT a, b FROM both_ WHERE a IN (SELECT doc_id FROM core) AND b IN (SELECT doc_id FROM core)),
    reach(id, lab) AS (SELECT doc_id, doc_id FROM core UNION SELECT ce.b, reach.lab FROM reach JOIN ce ON ce.a = reach.id),
    lab AS (SELECT id, CASE WHEN id IN (SELECT doc_id FROM blank) THEN (SELECT min(doc_id) FROM blank) ELSE min(lab) END AS lab FROM reach GROUP BY id),
    border AS (SELECT both_.a, min(lab.lab) AS bl FROM both_ JOIN lab ON lab.id = both_.b GROUP BY both_.a)
    SELECT doc_id, CAST(coalesce(lab.lab, bl, -1) AS BIGINT) AS cluster, lab.lab IS NOT NULL AS core
    FROM documents LEFT JOIN lab ON lab.id = doc_id LEFT JOIN border ON border.a = doc_id""",
)
def q_dbscan_text(spark, sf):
    """DBSCAN of the documents' TF-IDF rows at Euclidean distance 0.5."""
    docs, members, pairs = _text_join(spark, sf)
    return SP.dbscan_sparse(docs, "doc_id", members, pairs, 5)


# M14 / M15 / M17 -------------------------------------------------------------------
@register("kmeans")
def q_kmeans(spark, sf):
    out, _ = C.kmeans(table(spark, sf, "embeddings"), "vec_id", "embedding", k=10, restarts=3)
    return out


@register("bisecting")
def q_bisecting(spark, sf):
    return C.bisecting(table(spark, sf, "embeddings"), "vec_id", "embedding", k=10)


@register("cluster_report")
def q_cluster_report(spark, sf):
    """Quality of the k-means clusters against the stored labels, one row per metric."""
    from corpusmill.session import cut_lineage

    emb = table(spark, sf, "embeddings")
    cl, _ = C.kmeans(emb, "vec_id", "embedding", k=10, restarts=3)
    j = cut_lineage(emb.select("vec_id", "label").join(cl, "vec_id"))
    out = None
    for name, fn in (("ari", ST.ari), ("completeness", ST.completeness), ("ami", ST.ami)):
        m = fn(j, "label", "cluster")
        row = cut_lineage(m.select(F.lit("kmeans").alias("method"), F.lit(10).alias("k"), F.lit(name).alias("metric"), F.col(m.columns[0]).cast("double").alias("value")))
        out = row if out is None else out.unionByName(row)
    return out


@register("text_cluster_report")
def q_text_cluster_report(spark, sf):
    """M14, M15, M16, M17 on text: TF-IDF rows of the documents clustered by three methods and several k, against their languages."""
    from corpusmill.session import cut_lineage

    docs = table(spark, sf, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    # kept are the counts, which are small on disk; each pass weighs them anew
    hashed, stages = M.transformed(docs, M.text_stages())
    hashed = hashed.select("doc_id", stages[0].getInputCol()).persist(StorageLevel.DISK_ONLY)
    rows = Pipeline(stages=stages).fit(hashed).transform(hashed).select("doc_id", "features")
    found = {(m, k): cut_lineage(C.fit_clusters(rows, "doc_id", m, k)) for m in ("kmeans", "bisecting") for k in (4, 8)}
    hashed.unpersist()
    ids, members, pairs = _text_join(spark, sf)
    found["dbscan", None] = SP.dbscan_sparse(ids, "doc_id", members, pairs, 5)
    r = C.report(docs, found, "doc_id", "lang")
    return r.select("method", "k", "clusters", *[F.round(c, 6).alias(c) for c in ("ari", "completeness", "ami")])
