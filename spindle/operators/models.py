"""Classifiers on TF-IDF features, and their evaluation.

* Linear SVM: `LinearSVC` (hinge loss + L2, OWL-QN), 100 iterations, regParam
  0.01, no intercept, no standardization: the objective of the SGD trainer of
  the original jobs, solved by a better optimizer. `SVMWithSGD` parity is
  available through `fit_svm_sgd`.
* Naive Bayes: multinomial, smoothing 1.0.
* AUC and accuracy are DataFrames (aggregates), not driver loops.

Fitting is iterative: the training features are cached once and each
iteration is one distributed tree-aggregate of a 65-wide gradient.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators.features import hashed_tfidf_stages
from spindle.operators.prefix import auc_rank_sum

# Settings of the original jobs.
SVM_BUCKETS = 65
SVM_ITERATIONS = 100
SVM_REG = 0.01
NB_SMOOTHING = 1.0


def svm_pipeline(num_features: int = SVM_BUCKETS, max_iter: int = SVM_ITERATIONS,
                 reg_param: float = SVM_REG, text: str = "sentence") -> Pipeline:
    svc = LinearSVC(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg_param,
                    fitIntercept=False, standardization=False)
    return Pipeline(stages=hashed_tfidf_stages(num_features, text) + [svc])


def nb_pipeline(num_features: int = SVM_BUCKETS, smoothing: float = NB_SMOOTHING,
                text: str = "sentence") -> Pipeline:
    nb = NaiveBayes(featuresCol="features", labelCol="label", smoothing=smoothing,
                    modelType="multinomial")
    return Pipeline(stages=hashed_tfidf_stages(num_features, text) + [nb])


def fit(pipeline: Pipeline, train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """Fit the feature stages, cache `(label, features)` for the iterations of
    the classifier (the last stage), then release them.

    Featurizing runs on all partitions of the input; with `partitions`, only the
    narrow feature rows are coalesced, as each iteration is a job with a task per
    partition, which a small training set pays a hundred times."""
    *features, classifier = pipeline.getStages()
    featurizer = Pipeline(stages=features).fit(train)
    rows = featurizer.transform(train).select("label", "features")
    cached = (rows.repartition(partitions) if partitions else rows).cache()
    try:
        return PipelineModel(stages=[*featurizer.stages, classifier.fit(cached)])
    finally:
        cached.unpersist()


def fit_hashed(pipeline: Pipeline, train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """`fit` for rows that are hashed already: (label, rawFeatures). The stages up to
    the hashing need no fit, so the result also takes texts. The cached rows keep
    the partitions of the input unless `partitions` says otherwise."""
    tokenizer, hashing, idf, classifier = pipeline.getStages()
    weights = idf.fit(train)
    rows = weights.transform(train).select("label", "features")
    cached = (rows.repartition(partitions) if partitions else rows).cache()
    try:
        return PipelineModel(stages=[tokenizer, hashing, weights, classifier.fit(cached)])
    finally:
        cached.unpersist()


def after_hashing(model: PipelineModel) -> PipelineModel:
    """The part of a model that takes hashed rows."""
    return PipelineModel(stages=model.stages[2:])


def svm_scores(model: PipelineModel, test: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw margin per row (`score`), the threshold-free SVM output."""
    out = model.transform(test)
    return out.select(*(keep or []), "label",
                      vector_to_array("rawPrediction")[1].alias("score"))


def predictions(model: PipelineModel, test: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return model.transform(test).select(*(keep or []), "label", "prediction")


def accuracy(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: accuracy = matching rows / all rows."""
    hit = (F.col(prediction) == F.col(label)).cast("bigint")
    return pred.agg(F.sum(hit).alias("n_correct"), F.count(F.lit(1)).alias("n_test")) \
        .select(F.try_divide(F.col("n_correct"), F.col("n_test")).alias("accuracy"), "n_correct", "n_test")


def area_under_roc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return auc_rank_sum(scored, score, label)


def fit_svm_sgd(train_features: DataFrame, iterations: int = SVM_ITERATIONS, step: float = 1.0,
                reg_param: float = SVM_REG, mini_batch_fraction: float = 1.0):
    """Parity path: the RDD-based `SVMWithSGD` trainer the original jobs used
    (labelled points from a `label`, `features` DataFrame)."""
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.linalg import Vectors as MLlibVectors
    from pyspark.mllib.regression import LabeledPoint

    points = train_features.select("label", "features").rdd.map(
        lambda r: LabeledPoint(r[0], MLlibVectors.fromML(r[1]))).cache()
    model = SVMWithSGD.train(points, iterations=iterations, step=step, regParam=reg_param,
                             miniBatchFraction=mini_batch_fraction)
    model.clearThreshold()
    return model
