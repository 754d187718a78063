"""Classifier, metrics and clustering (M-24..M-27, K-04)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.sampling import hash_split
from logloom.operators.vectors import check_model_size, sparse_rows

CLASSIFIER_FEATURES = ["fabstime", "day_of_week", "req_method_onehot", "body_bytes_sent",
                       "hash_url_features"]


def train_domain_classifier(train: DataFrame, label_col: str = "domain",
                            features: list[str] = CLASSIFIER_FEATURES, max_iter: int = 100):
    """M-24: multinomial logistic regression. The label index is fitted on
    the training rows. A label unseen in training is kept at scoring, with the
    index after all known labels: no class is predicted as that one, so such
    rows count as errors."""
    pipe = Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="label", handleInvalid="skip"),
        VectorAssembler(inputCols=features, outputCol="features"),
        # Larger row blocks only change how rows are stacked per task (the
        # fitted model is the same); it cuts per-iteration overhead.
        LogisticRegression(featuresCol="features", labelCol="label", family="multinomial",
                           maxIter=max_iter, maxBlockSizeInMB=8.0),
    ])
    model = pipe.fit(train)
    model.stages[0].setHandleInvalid("keep")
    return model


def save_model(model, path: str, overwrite: bool = False) -> None:
    """K-04: persist a fitted model or pipeline."""
    w = model.write()
    (w.overwrite() if overwrite else w).save(path)


def load_logistic(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


def classification_metrics(pred: DataFrame, label_col: str = "label",
                           prediction_col: str = "prediction") -> DataFrame:
    """M-26 from one confusion aggregate: accuracy, weighted precision,
    weighted recall and weighted F1 (the definitions of Spark's
    MulticlassMetrics; classes are the labels present). The confusion
    table has at most classes^2 rows."""
    conf = (pred.select(F.col(label_col).cast("double").alias("y"),
                        F.col(prediction_col).cast("double").alias("p"))
                .groupBy("y", "p").agg(F.count(F.lit(1)).alias("n")))
    # Each confusion cell counts towards its label class (n_label, tp) and
    # its predicted class (n_pred): one pass over the predictions, no join.
    zero = F.lit(0).cast("bigint")
    cells = conf.select(F.inline(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("n_label"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("n_pred")),
        F.struct(F.col("p").alias("c"), zero.alias("n_label"), zero.alias("tp"),
                 F.col("n").alias("n_pred")))))
    cls = (cells.groupBy("c").agg(F.sum("n_label").alias("n_label"), F.sum("tp").alias("tp"),
                                  F.sum("n_pred").alias("n_pred"))
                .filter(F.col("n_label") > 0))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.col("tp") / F.col("n_label")
    f1 = F.when((prec + rec) > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    cls = cls.select("n_label", "tp", prec.alias("prec"), rec.alias("rec"), f1.alias("f1"))
    tot = F.sum("n_label")
    return cls.agg(
        (F.sum("tp") / tot).alias("accuracy"),
        (F.sum(F.col("prec") * F.col("n_label")) / tot).alias("weighted_precision"),
        (F.sum(F.col("rec") * F.col("n_label")) / tot).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("n_label")) / tot).alias("f1"),
    )


def kmeans_clusters(df: DataFrame, features: list[str], k: int = 25, seed: int = 1,
                    prediction_col: str = "cluster"):
    """M-27: k-means inside a pipeline (assemble + KMeans)."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"),
                            KMeans(k=k, seed=seed, predictionCol=prediction_col)])
    model = pipe.fit(df)
    return model, model.transform(df)


@dataclass
class HeldOut:
    """A classifier with its rows of the test side, scored."""

    model: PipelineModel
    train: DataFrame
    scored: DataFrame

    def metrics(self) -> DataFrame:
        """M-26 on rows the model never saw; a label unseen in training
        counts as an error."""
        return classification_metrics(self.scored)

    def by_label(self, label_col: str = "domain") -> DataFrame:
        """For each label of the held-out rows: how many there are, how many
        were told right, and the label's recall."""
        right = F.count_if(F.col("label") == F.col("prediction"))
        return self.scored.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"), right.alias("right"), (right / F.count(F.lit(1))).alias("recall"))


def train_and_hold_out(df: DataFrame, key: str, label_col: str = "domain", features: list[str] = CLASSIFIER_FEATURES,
                       train_fraction: float = 0.8, seed: int = 0, max_iter: int = 100, portable: bool = False) -> HeldOut:
    """M-24 to M-26 end to end: split by the row key's hash (the same rows on
    any layout), index the labels and fit on the training side, score the
    other side."""
    train, test = hash_split(df, [train_fraction, 1 - train_fraction], key, seed, portable)
    model = train_domain_classifier(train, label_col, features, max_iter)
    return HeldOut(model, train, model.transform(test))


def softmax_loss(df: DataFrame, features: str, label: str, coefficients: np.ndarray,
                 intercepts: np.ndarray, standardize: bool = False, reg: float = 0.0) -> tuple[float, np.ndarray, np.ndarray]:
    """M-24 check: mean multinomial loss of a model over ``df`` and its
    gradient (classes x features, classes), as one distributed aggregate over
    sparse rows. At a finished fit the gradient is near zero. Rows with a null
    label or one of no class are left out. ``reg`` adds an L2 penalty on the
    coefficients."""
    k, dim = coefficients.shape
    check_model_size(coefficients)
    by_feature = np.ascontiguousarray(coefficients.T)
    src = df.where((F.col(label) >= 0) & (F.col(label) < k)).select(F.unwrap_udt(F.col(features)).alias("x"), F.col(label).cast("int").alias("y"))

    def run(batches):
        slope, shift, loss, n = np.zeros((dim, k)), np.zeros(k), 0.0, 0
        for batch in batches:
            x, y = sparse_rows(batch.column("x"), dim), batch.column("y").to_numpy()
            most = max(1, (1 << 22) // max(1, k))
            lo = 0
            while lo < len(x):
                hi = min(max(int(np.searchsorted(x.start, x.start[lo] + most, "right")) - 1, lo + 1), lo + most, len(x))
                blk, own = x.rows(lo, hi), y[lo:hi]
                z = blk.row_sums(blk.value[:, None] * by_feature[blk.index]) + intercepts
                z -= z.max(axis=1, keepdims=True)
                total = np.log(np.exp(z).sum(axis=1))
                loss += float((total - z[np.arange(len(own)), own]).sum())
                p = np.exp(z - total[:, None])
                p[np.arange(len(own)), own] -= 1.0
                np.add.at(slope, blk.index, blk.value[:, None] * p[blk.row_of_entry()])
                shift += p.sum(axis=0)
                n += len(own)
                lo = hi
        if n:  # one row a class, and one for the counts
            for c in range(k):
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([np.append(slope[:, c], shift[c])], pa.list_(pa.float64()))], ["c", "s"])
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([np.append(np.zeros(dim - 1), [loss, n])], pa.list_(pa.float64()))], ["c", "s"])

    sums = src.mapInArrow(run, "c int, s array<double>").groupBy("c").agg(Summarizer.sum(array_to_vector("s")).alias("s"))
    got = {r["c"]: r["s"].toArray() for r in sums.collect()}  # classes + 1 rows of the model's size
    if not got:
        raise ValueError("no rows with a label")
    n = got[-1][-1]
    slope = np.stack([got[c][:dim] for c in range(k)]) / n + reg * coefficients
    return float(got[-1][-2] / n + reg / 2 * (coefficients ** 2).sum()), slope, np.array([got[c][dim] for c in range(k)]) / n


def lloyd_step(df: DataFrame, features: list[str], centers: list[list[float]]) -> DataFrame:
    """M-27, one step: every row joins its nearest center (squared Euclidean
    distance, ties to the smaller number), a center moves to the mean of its
    rows. Columns: cluster, n, one mean for each feature; a center without
    rows has no row. ``centers`` are literals (bounded by the model size)."""
    check_model_size(np.array(centers))

    def apart(center: list[float]) -> Column:
        return sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(features, center)), F.lit(0.0))

    near = F.array_min(F.array(*[F.struct(apart(c).alias("d"), F.lit(k).alias("cluster")) for k, c in enumerate(centers)]))
    placed = df.select(*features, near.getField("cluster").cast("bigint").alias("cluster"))
    return placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in features])
