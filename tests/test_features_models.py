"""TF-IDF (exact and hashed), AUC, Naive Bayes, SVM."""

import math

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, IDF, Tokenizer
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from spindle.operators import features as feat
from spindle.operators import models
from spindle.operators.naive_bayes import nb_exact
from spindle.operators.prefix import auc_rank_sum, global_cumsum
from spindle.operators.setops import hash_split, subtract_keep_duplicates, union_all
from spindle.plans import derived, queries
from tests.conftest import SF001, SF01

F1 = [(0.0, "Hi I heard about Spark"), (0.0, "I wish Java could use case classes"),
      (1.0, "Logistic regression models are neat")]


def test_hashing_idf_values(spark):
    df = spark.createDataFrame(F1, "label double, sentence string")
    pm = feat.hashed_tfidf(df, 20)
    out = pm.transform(df).collect()
    idf = pm.stages[-1].idf.toArray()
    raw = [r.rawFeatures.toArray() for r in out]
    for j in range(20):
        dfreq = sum(1 for v in raw if v[j] > 0)
        assert abs(idf[j] - math.log(4 / (dfreq + 1))) < 1e-12
    assert any(abs(x - math.log(4 / 2)) < 1e-9 for x in idf) and any(abs(x - math.log(4 / 3)) < 1e-9 for x in idf)


def test_exact_tfidf_matches_countvectorizer_idf(spark):
    docs = spark.createDataFrame([(i, s) for i, (_, s) in enumerate(F1)], "doc_id long, text string")
    tf = feat.term_frequencies(feat.doc_tokens(docs))
    idf = feat.inverse_document_frequencies(tf, feat.n_docs_of(docs))
    ours = {r.term: r.idf for r in idf.collect()}
    pm = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="w"), CountVectorizer(inputCol="w", outputCol="c"),
                          IDF(inputCol="c", outputCol="f")]).fit(docs)
    vocab, weights = pm.stages[1].vocabulary, pm.stages[2].idf.toArray()
    assert {t: w for t, w in zip(vocab, weights)} == {t: ours[t] for t in vocab}


def test_auc_rank_sum_matches_evaluator(spark):
    rows = [(float(s % 17) + (0.5 if s % 5 == 0 else 0.0), float((s * 7) % 3 == 0)) for s in range(300)]
    df = spark.createDataFrame(rows, "score double, label double")
    ours = auc_rank_sum(df, blocks=8).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC")
    ev.setNumBins(0)
    assert abs(ours - ev.evaluate(df)) < 1e-9


def test_global_cumsum_matches_single_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2003).alias("o"), (F.col("id") % 5).alias("v"))
    ours = {r.o: r.cum_v for r in global_cumsum(df, "o", ["v"], blocks=9).collect()}
    w = Window.orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.o: r.c for r in df.select("o", F.sum("v").over(w).alias("c")).collect()}
    assert ours == want


def test_nb_exact_matches_pipeline_nb(spark):
    lab = derived.labelled_docs(spark, SF001)
    train, test = hash_split(lab, "doc_id", 0.6, 11)
    ours = {r.doc_id: r.prediction for r in nb_exact(train, test).collect()}
    pipe = Pipeline(stages=[Tokenizer(inputCol="sentence", outputCol="w"),
                            CountVectorizer(inputCol="w", outputCol="c", minDF=1.0),
                            IDF(inputCol="c", outputCol="features"),
                            NaiveBayes(smoothing=1.0, modelType="multinomial")]).fit(train)
    ml = {r.doc_id: r.prediction for r in pipe.transform(test).collect()}
    assert ours == ml and len(ours) > 0


def test_split_subtract_union(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "id long, t string")
    right = spark.createDataFrame([(2, None)], "id long, t string")
    assert sorted(tuple(r) for r in subtract_keep_duplicates(df, right).collect()) == [(1, "a"), (1, "a"), (3, "c")]
    assert union_all(df, right).count() == 5
    lab = derived.labelled_docs(spark, SF001)
    tr, te = hash_split(lab, "doc_id", 0.6)
    assert tr.count() + te.count() == lab.count()
    assert tr.join(te, "doc_id").count() == 0
    assert sorted(r.doc_id for r in subtract_keep_duplicates(lab, tr).collect()) == sorted(r.doc_id for r in te.collect())


def test_svm_auc_close_to_sgd(spark):
    lab = derived.labelled_docs(spark, SF01)
    train, test = hash_split(lab, "doc_id", 0.6, 11)
    pm = models.fit(models.svm_pipeline(), train)
    ours = models.area_under_roc(models.svm_scores(pm, test)).first().auc
    assert 0.5 < ours <= 1.0
    fe = feat.hashed_tfidf(train, 65)
    sgd = models.fit_svm_sgd(fe.transform(train))
    from pyspark.mllib.linalg import Vectors as MV
    w = sgd.weights.toArray()
    scored = fe.transform(test).select("label", "features").collect()
    sc = spark.createDataFrame([(float(MV.fromML(r.features).dot(w)), r.label) for r in scored],
                               "score double, label double")
    assert abs(auc_rank_sum(sc).first().auc - ours) < 0.1


def test_auc_and_accuracy_degenerate_inputs(spark):
    one_class = spark.createDataFrame([(0.3, 1.0), (0.7, 1.0)], "score double, label double")
    r = auc_rank_sum(one_class).first()
    assert r.auc is None and r.n_pos == 2 and r.n_neg == 0
    empty = spark.createDataFrame([], "prediction double, label double")
    a = models.accuracy(empty).first()
    assert a.accuracy is None and a.n_test == 0


def test_hashing_tf_buckets_match_index_of(spark):
    df = spark.createDataFrame(F1, "label double, sentence string")
    pm = feat.hashed_tfidf(df, 20)
    for r in pm.transform(df).collect():
        want = {}
        for t in r.words:
            j = feat.term_bucket(t, 20)
            want[j] = want.get(j, 0) + 1
        raw = r.rawFeatures
        assert {int(i): float(v) for i, v in zip(raw.indices, raw.values)} == {k: float(v) for k, v in want.items()}


def test_fit_on_hashed_rows_equals_fit_on_texts(spark):
    """The narrow path of the queries: the same model as from texts, any partitions."""
    lab = derived.labelled_docs(spark, SF001)
    train, test = hash_split(lab, "doc_id", 0.6, 11)
    hashed = feat.hashed_tf(train, 65).select("label", "rawFeatures")
    for pipe in (models.svm_pipeline(), models.nb_pipeline()):
        text = models.predictions(models.fit(pipe, train), test, keep=["doc_id"])
        for partitions in (None, 3):
            model = models.fit_hashed(pipe, hashed, partitions)
            assert sorted(models.predictions(model, test, keep=["doc_id"]).collect()) == sorted(text.collect())
            rows = feat.hashed_tf(test, 65).select("doc_id", "label", "rawFeatures")
            assert sorted(models.predictions(models.after_hashing(model), rows, keep=["doc_id"]).collect()) == sorted(text.collect())


def test_model_queries_never_shuffle_texts(spark):
    for name in ("svm_scores", "nb_accuracy", "score_new"):
        plan = queries.QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "text" not in plan and "sentence" not in plan, name
