"""Model jobs on MLlib pipelines.

Feature extraction, fitting and scoring are MLlib stages (distributed passes,
sparse vectors kept sparse); metrics reuse the SQL aggregates of
``corpusmill.operators.stats``. Cross-validation fits the vectoriser inside each
fold (Q12).
"""
from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import VEC_TOKEN
from corpusmill.operators import stats as ST
from corpusmill.session import stored

#: Slots that terms are hashed to, unless a caller passes another number; ``term_slots`` shows how many terms share one.
NUM_HASH_FEATURES = 1 << 17


class SmoothIDF(Estimator, HasInputCol, HasOutputCol):
    """Weights tf * (ln((1 + N) / (1 + df)) + 1), as ``features.tfidf_raw`` has them: MLlib's IDF and one more tf. The fitted
    stage is MLlib's own product with a fixed vector, so it is stored and loaded as any other."""

    @keyword_only
    def __init__(self, *, inputCol: str, outputCol: str) -> None:
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, df: DataFrame) -> ElementwiseProduct:
        weights = IDF(inputCol=self.getInputCol()).fit(df).idf.toArray() + 1.0
        return ElementwiseProduct(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), scalingVec=Vectors.dense(weights))


def text_stages(text: str = "text", vocab: bool = False, idf: bool = True, min_df: float = 1.0,
                n_features: int = NUM_HASH_FEATURES, vocab_size: int = 1 << 24) -> list:
    """Tokenise (vectoriser pattern, lower-case) -> stop words -> counts -> IDF (M2) -> L2.

    ``vocab=True`` uses CountVectorizer (at most ``vocab_size`` terms, fitted and held by the model);
    the default hashes terms to ``n_features`` slots, so nothing vocabulary-sized reaches the driver.
    """
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=VEC_TOKEN, gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_tok", outputCol="_terms"),
    ]
    tf_out = "_tf"
    if vocab:
        stages.append(CountVectorizer(inputCol="_terms", outputCol=tf_out, minDF=min_df, vocabSize=vocab_size))
    else:
        stages.append(HashingTF(inputCol="_terms", outputCol=tf_out, numFeatures=n_features))
    if idf:
        stages += [SmoothIDF(inputCol=tf_out, outputCol="_tfidf"), Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)]
    else:
        stages.append(Normalizer(inputCol=tf_out, outputCol="features", p=2.0))
    return stages


def term_slots(docs: DataFrame, text: str = "text", n_features: int = NUM_HASH_FEATURES) -> DataFrame:
    """Distinct terms, slots in use and terms that share a slot under the hashing of ``text_stages``."""
    pre = Pipeline(stages=text_stages(text, idf=False, n_features=n_features)[:2]).fit(docs).transform(docs)
    terms = pre.select(F.explode("_terms").alias("t")).distinct().select(F.array("t").alias("_terms"))
    slots = HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=n_features).transform(terms)
    per = slots.groupBy("_tf").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("terms"), F.count(F.lit(1)).alias("slots"),
                   F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("shared"))


def class_names(df: DataFrame, label: str = "label") -> list[str]:
    """The class names of an indexed label column, in the order of its indices (column metadata)."""
    return list(df.schema[label].metadata["ml_attr"]["vals"])


def classifier(kind: str, label: str = "label", **kw):
    """M4-M12 estimators by name."""
    common = dict(featuresCol="features", labelCol=label)
    if kind in ("multinomial", "complement", "bernoulli", "gaussian"):
        return NaiveBayes(modelType=kind, **common, **kw)
    if kind == "dt_gini":
        return DecisionTreeClassifier(impurity="gini", maxDepth=kw.pop("maxDepth", 10), seed=42, **common, **kw)
    if kind == "dt_entropy":
        return DecisionTreeClassifier(impurity="entropy", maxDepth=kw.pop("maxDepth", 10), seed=42, **common, **kw)
    if kind == "rf":
        return RandomForestClassifier(numTrees=kw.pop("numTrees", 100), impurity=kw.pop("impurity", "entropy"),
                                      seed=42, **common, **kw)
    if kind == "linear_ovr":
        return OneVsRest(classifier=LinearSVC(regParam=kw.pop("regParam", 1e-4), maxIter=kw.pop("maxIter", 20)),
                         parallelism=4, **common)
    if kind == "logistic":
        return LogisticRegression(maxIter=100, **common, **kw)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=kw.pop("layers"), maxIter=kw.pop("maxIter", 100), seed=42,
                                              **common, **kw)
    raise ValueError(kind)


def transformed(df: DataFrame, stages: list) -> tuple[DataFrame, list]:
    """The rows after the leading stages that learn nothing, and the stages that are left."""
    n = next((i for i, s in enumerate(stages) if not isinstance(s, Transformer)), len(stages))
    for s in stages[:n]:
        df = s.transform(df)
    return df, stages[n:]


def prepared(df: DataFrame, stages: list, keep: Sequence[str]) -> tuple[DataFrame, list]:
    """The rows after the leading stages that learn nothing, stored once for all fits and scores that read them, and the stages
    that are left. Kept are ``keep`` and what those stages read."""
    rows, rest = transformed(df, stages)
    made = {c: None for c in keep}
    for s in rest:
        for c in (s.getInputCols() if s.hasParam("inputCols") and s.isSet("inputCols") else [s.getInputCol()]):
            if c in rows.columns:
                made[c] = None
    if not rest:
        made["features"] = None
    return stored(rows.select(*made), "prepared"), rest


def fit_predict(train: DataFrame, test: DataFrame, stages: list, est, keep: Sequence[str]) -> DataFrame:
    """Fit stages + estimator on train, score test: keep columns + label + prediction."""
    model = Pipeline(stages=[*stages, est]).fit(train)
    return model.transform(test).select(*keep, F.col("prediction").cast("double").alias("prediction"))


def one_vs_rest(train: DataFrame, classifier, label: str = "label", features: str = "features") -> OneVsRestModel:
    """``OneVsRest(classifier).fit(train)``, one class after the other and without a copy of the rows beside the classifier's own."""
    model = OneVsRest(classifier=classifier, labelCol=label, featuresCol=features)
    models = []
    for c in range(int(train.agg(F.max(label)).first()[0]) + 1):
        rows = train.select(features, F.when(F.col(label) == float(c), 1.0).otherwise(0.0).alias("__class"))
        models.append(classifier.fit(rows, {classifier.labelCol: "__class", classifier.featuresCol: features, classifier.predictionCol: model.getPredictionCol()}))
    return model._copyValues(OneVsRestModel(models=models))


def index_labels(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    """F1 for models: string label -> double index in sorted order."""
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc").fit(df).transform(df)


def tabular_stages(cols: Sequence[str], scale: bool = False) -> list:
    """Assemble feature columns into one vector (optionally standardised)."""
    st = [VectorAssembler(inputCols=list(cols), outputCol="_raw" if scale else "features", handleInvalid="keep")]
    if scale:
        st.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True))
    return st


def rbf_features(df: DataFrame, in_col: str = "features", dim: int = 256, gamma: float | None = None,
                 seed: int = 42, n_in: int | None = None) -> DataFrame:
    """M7: random Fourier features z(x) = sqrt(2/D) cos(Wx + b), W ~ N(0, 2 gamma)
    (Rahimi & Recht 2007), so a linear SVM on z approximates an RBF-kernel SVM.
    W is n_in x D, fixed by the seed and independent of the data size; each Arrow
    batch is one matrix product."""
    from pyspark.ml.functions import array_to_vector

    n_in = n_in or len(df.select(in_col).first()[0])
    gamma = gamma or 1.0 / n_in
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2 * gamma), size=(n_in, dim))
    b = rng.uniform(0, 2 * np.pi, size=dim)
    scale = np.sqrt(2.0 / dim)

    @F.pandas_udf("array<double>")
    def rff(x: pd.Series) -> pd.Series:
        m = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, n_in))
        z = np.cos(m @ w + b) * scale
        return pd.Series(list(z))

    from pyspark.sql.types import ArrayType

    src = F.col(in_col) if isinstance(df.schema[in_col].dataType, ArrayType) else vector_to_array(F.col(in_col))
    return df.withColumn("features", array_to_vector(rff(src.cast("array<double>"))))


def accuracy_table(pred: DataFrame, label: str = "label", name: str = "model") -> DataFrame:
    """One row (model, accuracy, weighted precision / recall / F1)."""
    m = ST.prf(pred.select(F.col(label).alias("y"), F.col("prediction").alias("p")), average="weighted")
    return m.select(F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1")


def cross_validate(df: DataFrame, stages: list, est, label: str = "label", folds: str = "fold",
                   k: int = 5) -> DataFrame:
    """Fit on k-1 folds, score the held-out fold; per-fold metric rows."""
    out = None
    df, stages = prepared(df, stages, [label, folds])
    for f in range(k):
        train, test = df.filter(F.col(folds) != f), df.filter(F.col(folds) == f)
        pred = fit_predict(train, test, stages, est, [label])
        row = accuracy_table(pred, label, "cv").withColumn("fold", F.lit(f))
        out = row if out is None else out.unionByName(row)
    return out


def calibrate(scored: DataFrame, label: str = "label", raw: str = "rawPrediction", n_classes: int | None = None):
    """Platt scaling per class on the raw margin (one-vs-rest), renormalised so
    each row's probabilities sum to 1. Returns (model list, scoring function)."""
    n_classes = n_classes or int(scored.agg(F.max(label)).first()[0]) + 1
    from corpusmill.session import cut_lineage

    # the margins are materialised once; every per-class fit reads only them
    base = cut_lineage(scored.select(F.col(label), vector_to_array(F.col(raw)).alias("_raw_arr")))
    fits = []
    for c in range(n_classes):
        d = base.select(F.when(F.col(label) == c, 1.0).otherwise(0.0).alias("y"),
                        F.col("_raw_arr")[c].alias("m"))
        d = VectorAssembler(inputCols=["m"], outputCol="features").transform(d)
        fits.append(LogisticRegression(featuresCol="features", labelCol="y", maxIter=100).fit(d))
    coefs = [(float(m.coefficients[0]), float(m.intercept)) for m in fits]

    def score(df: DataFrame) -> DataFrame:
        a = vector_to_array(F.col(raw))
        ps = [F.lit(1.0) / (F.lit(1.0) + F.exp(-(a[c] * w + b))) for c, (w, b) in enumerate(coefs)]
        tot = ps[0]
        for p in ps[1:]:
            tot = tot + p
        return df.withColumn("probs", F.array(*[p / tot for p in ps]))

    return coefs, score


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline; a missing bundle asks to train first."""
    try:
        return PipelineModel.load(path)
    except Exception as e:  # missing or unreadable bundle
        raise FileNotFoundError(f"no model at {path}: train the model first") from e
