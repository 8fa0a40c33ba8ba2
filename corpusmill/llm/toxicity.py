"""Operator 6: toxicity by non-negative positive-unlabelled learning in numpy.

The classifier is linear over the hashed words of a text and the hashed first
``PREFIXES`` bytes of its longer words, present or not. It is trained from confirmed toxic
examples and unlabelled text with the risk estimator

    prior * R+(P) + max(0, R-(U) - prior * R-(P)),

where R+ and R- are mean losses of calling a text toxic or clean. When the
second part turns negative, its gradient is followed upwards, so that it cannot
be driven below zero by memorising. The prior is the toxic share of labelled training rows. Clean labels serve for
that share only.

The fit uses at most ``MAX_POSITIVE`` toxic and ``MAX_UNLABELLED`` other training texts,
chosen by a hash of doc_id: the documented bound on what the driver holds. Scoring reads
every whole text in one pass without a shuffle.

Defined results: null or empty text has no features and the score of the intercept;
a null doc_id or label is never trained on (its text is scored, held_out is false);
repeated rows are each scored; without toxic training rows every score is 0; an
empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import TEXT_BYTES, map_slices, release, strings, text_slices
from corpusmill.llm.shingles import mix, prefix_hashes, word_hashes

SLOTS = 1 << 20
#: Bytes of text whose features a task holds at once.
SLICE = TEXT_BYTES >> 2
PREFIXES = (4, 5)
#: Bounds of the training sample.
MAX_POSITIVE, MAX_UNLABELLED = 5_000, 10_000
#: A feature is trained if so many toxic texts of the sample have it, and they exceed what
#: the unlabelled texts lead to expect by so many standard deviations.
MIN_TEXTS, SIGNAL = 4, 4.0


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, slots): the distinct feature slots of each text, sorted."""
    off, words = word_hashes(texts)
    parts = [words, *(mix(prefix_hashes(texts, k) ^ np.uint64(k)) for k in PREFIXES)]
    slots = np.stack([(p >> np.uint64(20)).astype(np.int64) % SLOTS for p in parts], axis=1).astype(np.int32)
    each = [np.unique(slots[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    return np.cumsum([0, *map(len, each)]), np.concatenate([*each, np.zeros(0, np.int32)])


def margins(off: np.ndarray, slots: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Sum of weights over each text's features, plus the intercept."""
    total = np.concatenate([[0.0], np.cumsum(weights[slots], dtype=np.float64)])
    return total[off[1:]] - total[off[:-1]] + bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=float)))


#: The loss of a margin and its slope: logistic in the first half of the epochs, which is convex and finds
#: all kinds of positives, then sigmoid, which is bounded and drops false ones.
LOSSES = (
    (lambda z: np.logaddexp(0, -z), lambda z: -sigmoid(-z)),
    (lambda z: sigmoid(-z), lambda z: -sigmoid(z) * sigmoid(-z)),
)


def fit(off_p, slots_p, off_u, slots_u, prior: float, epochs: int = 500, rate: float = 0.05, decay: float = 1e-5, gamma: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights (one a slot) and intercept by full-batch Adam on the non-negative risk."""
    n_p, n_u = len(off_p) - 1, len(off_u) - 1
    in_p, in_u = np.bincount(slots_p, minlength=SLOTS), np.bincount(slots_u, minlength=SLOTS)
    expected = in_u * (n_p / max(1, n_u))
    used = np.flatnonzero((in_p >= MIN_TEXTS) & (in_p - expected > SIGNAL * np.sqrt(expected + 1)))
    index = np.full(SLOTS, -1, np.int32)
    index[used] = np.arange(len(used))

    def kept(off, slots):
        i = index[slots]
        ok = i >= 0
        return np.concatenate([[0], np.cumsum(ok, dtype=np.int32)])[off], i[ok]

    off_p, x_p = kept(off_p, slots_p)
    off_u, x_u = kept(off_u, slots_u)
    doc_p, doc_u = np.repeat(np.arange(n_p), np.diff(off_p)), np.repeat(np.arange(n_u), np.diff(off_u))
    w, b = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, epochs + 1):
        f_p, f_u = margins(off_p, x_p, w, b), margins(off_u, x_u, w, b)
        loss, slope = LOSSES[t > epochs // 2]
        negative = loss(-f_u).mean() - prior * loss(-f_p).mean()  # R-(U) - prior * R-(P)
        if negative >= 0:
            g_p, g_u = prior * (slope(f_p) + slope(-f_p)) / n_p, -slope(-f_u) / n_u
        else:
            g_p, g_u = -gamma * prior * slope(-f_p) / n_p, gamma * slope(-f_u) / n_u
        g = np.bincount(x_p, weights=g_p[doc_p], minlength=len(used)) + np.bincount(x_u, weights=g_u[doc_u], minlength=len(used))
        g = np.append(g + decay * w, g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
        w, b = w - step[:-1], b - step[-1]
    out = np.zeros(SLOTS, np.float32)
    out[used] = w
    return out, float(b)


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 5; fold 0 is held out."""
    return F.crc32(doc_id.cast("string")) % 5


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(slots, weights, intercept) of the classifier, or None without toxic training rows."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior or prior >= 1:
        return None
    order = F.xxhash64("doc_id", F.lit(6))
    toxic = known.filter("toxic = 1").select("doc_id").orderBy(order, "doc_id").limit(max_positive)
    other = docs.select("doc_id").filter(fold(F.col("doc_id")) != 0).orderBy(order, "doc_id").limit(max_unlabelled)
    # at most max_positive + max_unlabelled ids: a proven bound for the broadcast
    chosen = toxic.select("doc_id", F.lit(True).alias("p")).unionByName(other.distinct().select("doc_id", F.lit(False).alias("p")))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                off, slots = features(strings(part, "text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("p"), pa.ListArray.from_arrays(off.astype(np.int32), slots)], names=["doc_id", "p", "slots"])
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # one row an id and side at most, however often a doc_id is repeated
    got = rows.mapInArrow(run, "doc_id long, p boolean, slots array<int>").dropDuplicates(["doc_id", "p"]).select("p", "slots").toArrow()

    def side(positive: bool) -> tuple[np.ndarray, np.ndarray]:
        col = got.filter(pa.compute.equal(got["p"], positive))["slots"].combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.list_(pa.int32()))
        offsets = col.offsets.to_numpy()
        return offsets - offsets[0], col.values.to_numpy()[offsets[0] : offsets[-1]]

    p, u = side(True), side(False)
    if len(p[0]) < 2 or len(u[0]) < 2:
        return None
    del got
    weights, bias = fit(*p, *u, prior)
    slots = np.flatnonzero(weights)
    model = slots, weights[slots], bias
    del p, u, weights
    release()  # the driver goes on to other work
    return model


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row and its score, from the whole text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields) + ", score double"

    def make():
        weights = np.zeros(SLOTS)
        if model:
            weights[model[0]] = model[1]

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            if model:
                s = sigmoid(margins(*features(strings(part, "__text")), weights, model[2]))
            else:
                s = np.zeros(part.num_rows)
            return pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(s)], names=[*keep, "score"])

        return one

    return map_slices(docs.select(*keep, F.col("text").alias("__text")), "__text", make, schema, SLICE)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores below one half, all columns unchanged; one pass, no join."""
    model = train(docs, labels)
    if model is None:
        return docs

    def run(batches):
        weights = np.zeros(SLOTS)
        weights[model[0]] = model[1]
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                s = sigmoid(margins(*features(strings(part, "text")), weights, model[2]))
                yield part.filter(pa.array(s < 0.5))
        release()

    return docs.mapInArrow(run, docs.schema)
