"""Toxicity: a bidirectional GRU with attention pooling scores every window of a text.

Windows of ``WINDOW`` words start every ``STRIDE`` words and cover the whole text, however
long.  A document's score is a logistic function of its windows' largest and mean logit and
of their number, fitted on documents that the network was not trained on.

The network and the logistic function are trained on the driver, on a bounded sample: at
most ``SAMPLE`` labelled documents of each class, those with the smallest hashes of their
ids, and of all windows of their whole texts about ``SAMPLE_WINDOWS`` of each class, those
with the smallest hashes of id and position.  Everything else runs in tasks: the
network goes out as a broadcast of fixed size, no shuffle is needed.

Texts without words score 0.  Rows with a NULL label, and labels without a document, teach
nothing; of several labels of one id the largest counts.  Without labels of both classes
nothing can be learned: every score is then the share of toxic labels (0 without labels).
Repeated rows are scored each, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.arrow import slices
from alertfold.llm.common import cut
from alertfold.llm.gru import Gru, train, words_of

WINDOW, STRIDE = 128, 64
SAMPLE = 2500
SAMPLE_WINDOWS = 7500
TRAIN_STEPS = 500
SCORE_WINDOWS = 1024
THRESHOLD = 0.7


def starts(n: int) -> list[int]:
    """Where the windows of a text of n words start; the last one ends the text."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def fold(id_col):
    """0, 1 or 2; labels of fold 1 are held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def window_logits(net: Gru, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest logit, mean logit and number of windows per text."""
    top, total, many = [], [], []
    held: list[tuple[int, np.ndarray]] = []

    def flush():
        if not held:
            return
        held.sort(key=lambda w: -len(w[1]))
        length = np.array([len(w) for _, w in held])
        index = np.zeros((len(held), length[0]), np.int32)
        for k, (_, w) in enumerate(held):
            index[k, :len(w)] = w
        for (doc, _), logit in zip(held, net.logits(index, length)):
            top[doc] = max(top[doc], float(logit))
            total[doc] += float(logit)
        held.clear()

    for doc, text in enumerate(texts):
        words = words_of(text)
        top.append(-np.inf)
        total.append(0.0)
        many.append(len(starts(len(words))) if words else 0)
        if not words:
            continue
        if net.full():
            flush()  # places hold while windows refer to them
            net.forget()
        rows = net.rows(words)
        for s in starts(len(words)):
            held.append((doc, rows[s:s + WINDOW]))
            if len(held) >= SCORE_WINDOWS:
                flush()
    flush()
    n = np.array(many)
    return np.array(top), np.array(total) / np.maximum(n, 1), n


def _features(top, mean, n) -> np.ndarray:
    return np.stack([np.ones(len(n)), np.where(n > 0, top, 0), mean, np.log(np.maximum(n, 1))], 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (p - y) + ridge * w)
    return w


def sample_labels(labels: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` ids of each class outside the held-out fold: ``id, toxic, use``; every
    fourth is kept for the logistic function."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold("doc_id") != 1)
             .groupBy(F.col("doc_id").alias("id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    of = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for c in (0, 1)]
    return of[0].unionByName(of[1]).withColumn("use", F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(4)).cast("int"))


def _window_counts(batches):
    for batch in batches:
        n = [len(starts(len(words))) if words else 0 for words in map(words_of, batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["toxic", "n"])


def _sample_windows(share: dict[int, float]):
    """Of every class ``share`` of its windows, wherever in the texts they lie."""
    def run(batches):
        for batch in batches:
            out = []
            for i, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                for s in starts(len(words)) if words else ():
                    if xxhash.xxh3_64_intdigest(f"{i}:{s}") < share[toxic] * 2 ** 64:
                        out.append({"toxic": toxic, "window": " ".join(words[s:s + WINDOW]), "id": str(i)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("id", pa.string()), ("toxic", pa.int32()), ("window", pa.string())]))
    return run


def _scorer(net):
    """Largest and mean logit and number of windows, for (key, text) batches."""
    def run(batches):
        own = Gru(net.value)
        for batch in batches:
            top, mean, n = window_logits(own, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(top), pa.array(mean),
                                              pa.array(n.astype(np.int64))], names=["key", "top", "mean", "n"])
    return run


def _probability(weights, top, mean, n) -> np.ndarray:
    z = np.where(n > 0, _features(top, mean, n) @ weights, -np.inf) if len(n) else np.empty(0)
    return 1 / (1 + np.exp(-np.clip(z, -700, 700))) * (n > 0)


def fit(docs: DataFrame, labels: DataFrame):
    """The trained network (a broadcast) and the logistic weights, or the constant score."""
    spark = docs.sparkSession
    picked = sample_labels(labels).toPandas()
    rate = float(picked["toxic"].mean()) if len(picked) else 0.0
    if picked["toxic"].nunique() < 2:
        return None, rate
    # the ids of the sample are bounded by 2 * SAMPLE, so they can go to every task
    ids = F.broadcast(spark.createDataFrame(picked))
    texts = cut(docs.join(ids, docs.doc_id == ids.id).select("id", F.col("toxic").cast("int").alias("toxic"), "use", "text"))
    taught = texts.filter("use > 0")
    many = {r.toxic: r.n for r in taught.select("toxic", "text").mapInArrow(_window_counts, "toxic int, n long")
            .groupBy("toxic").agg(F.sum("n").alias("n")).collect()}  # a row a class
    share = {c: min(1.0, SAMPLE_WINDOWS / n) if n else 0.0 for c, n in many.items()}
    windows = (taught.select("id", "toxic", "text")
               .mapInArrow(_sample_windows(share), "id string, toxic int, window string").toPandas())
    if windows["toxic"].nunique() < 2:
        return None, rate
    windows = windows.sort_values(["id", "window"], kind="stable")
    net = train(windows["window"].tolist(), windows["toxic"].to_numpy(), TRAIN_STEPS)
    shared = spark.sparkContext.broadcast(net.p)
    seen: pd.DataFrame = (texts.filter("use = 0").select(F.col("toxic").alias("key"), "text")
                          .mapInArrow(_scorer(shared), "key int, top double, mean double, n bigint").toPandas())
    seen = seen[seen["n"] > 0].sort_values(["key", "top", "mean", "n"])
    if seen["key"].nunique() < 2:
        return shared, np.array([0.0, 1.0, 0.0, 0.0])
    return shared, _logistic(_features(seen["top"], seen["mean"], seen["n"]), seen["key"].to_numpy(float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    net, weights = fit(docs, labels)
    held_out = F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out")
    if net is None:
        out = docs.select("doc_id", held_out, F.lit(weights).alias("score"))
    else:
        kind = docs.schema["doc_id"].dataType.simpleString()
        out = (docs.mapInArrow(_scored(net, weights), f"doc_id {kind}, score double")
               .select("doc_id", held_out, "score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _scored(net, weights):
    def run(batches):
        own = Gru(net.value)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            p = _probability(weights, *window_logits(own, batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents of ``docs`` that score below the threshold, with all their columns."""
    net, weights = fit(docs.select("doc_id", F.col(text_col).alias("text")), labels)
    if net is None:
        return docs if weights < THRESHOLD else docs.limit(0)
    at = docs.columns.index(text_col)

    def run(batches):
        own = Gru(net.value)
        for batch in (part for whole in batches for part in slices(whole, at)):
            p = _probability(weights, *window_logits(own, batch.column(at).to_pylist()))
            yield batch.filter(pa.array(p < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
