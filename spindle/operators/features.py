"""Text features: tokens, term frequency, IDF, TF-IDF.

Two forms of the same thing:
  * exact terms as tables `(doc, term, tf, idf, tfidf)` - pure DataFrame
    aggregates and joins, checkable in SQL;
  * hashed vectors with `pyspark.ml` (Tokenizer -> HashingTF -> IDF) for the
    classifiers. The IDF is fitted on the training rows only, inside a
    `Pipeline`, so test rows never leak into it.

IDF = ln((n_docs + 1) / (df + 1)), Spark ML's formula, where n_docs counts
every document (also those without tokens).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.text import tokenize


def doc_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, pos, term)`, the tokens of `Tokenizer` with their position."""
    return docs.select(doc_id, F.posexplode(tokenize(F.col(text))).alias("pos", "term"))


def term_frequencies(tokens: DataFrame, doc_id: str = "doc_id", term: str = "term") -> DataFrame:
    return tokens.groupBy(doc_id, term).agg(F.count(F.lit(1)).alias("tf"))


def inverse_document_frequencies(tf: DataFrame, n_docs: Column, term: str = "term",
                                 min_doc_freq: int = 0) -> DataFrame:
    """`(term, df, idf)`. `n_docs` is a Column (e.g. a scalar subquery).

    df counts the rows with tf > 0 (every row: tf >= 1). Spelling it through
    the `tf` value keeps the term-frequency aggregate intact in this branch
    (a plain row count lets the optimizer reduce it to a distinct), so where
    that aggregate has its own (doc, term) shuffle - any input with enough
    splits - the shuffle is reused by the TF-IDF join branch and documents
    are tokenized once."""
    out = tf.groupBy(term).agg(F.sum(F.when(F.col("tf") > 0, 1).otherwise(0)).cast("bigint").alias("df"))
    if min_doc_freq:
        out = out.filter(F.col("df") >= min_doc_freq)
    return out.select(term, "df", F.ln((n_docs + 1) / (F.col("df") + 1)).alias("idf"))


def n_docs_of(docs: DataFrame) -> Column:
    """Document count as a scalar subquery Column (no collect, no cross join)."""
    return docs.agg(F.count(F.lit(1)).cast("double")).scalar()


def own_exchange(df: DataFrame, key: str) -> DataFrame:
    """`df` dealt out by a hash of `key`, so that a join on `key` has to exchange
    it again. A side that an aggregate left partitioned by the key has no exchange
    right under the join, and adaptive execution splits a hot key's partition
    only if both sides have one. For sides that are small next to the other."""
    return df.repartition(F.xxhash64(key))


def tfidf(tf: DataFrame, idf: DataFrame, term: str = "term") -> DataFrame:
    """Join on term. Neither side has a size bound (the vocabulary grows with
    the corpus), so both are dealt out by term and AQE splits a hot term's
    partition: a word like "the" is in nearly every document, so the (small) IDF
    side gets an exchange of its own. That side has a row per term and is the one
    hashed; the rows of (doc, term), the bulk of the job, are not sorted.

    The term frequency shuffle is shared with the IDF branch (see
    `inverse_document_frequencies`). The alternative, one shuffle of
    (doc, term) rows by term feeding both the document counts and a
    co-partitioned join, would put every row of a hot term in one task."""
    terms = own_exchange(idf.select(term, "idf"), term).hint("shuffle_hash")
    return tf.join(terms, term).withColumn("tfidf", F.col("tf") * F.col("idf"))


def hashed_tfidf_stages(num_features: int, text: str = "sentence"):
    return [
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="features"),
    ]


def hashed_tf(df: DataFrame, num_features: int = 65, text: str = "sentence") -> DataFrame:
    """`df` with `rawFeatures`, the hashed term frequencies."""
    words = Tokenizer(inputCol=text, outputCol="words").transform(df)
    return HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features).transform(words)


def fitted_idf(train: DataFrame):
    """IDF model of hashed rows (`rawFeatures` -> `features`)."""
    return IDF(inputCol="rawFeatures", outputCol="features").fit(train)


def hashed_tfidf(train: DataFrame, num_features: int = 65, text: str = "sentence"):
    """Fitted `PipelineModel` (tokenize, hash, IDF fitted on `train`)."""
    return Pipeline(stages=hashed_tfidf_stages(num_features, text)).fit(train)


def term_bucket(term: str, num_features: int) -> int:
    """Bucket `HashingTF` gives a term (its murmur3 hash, not SQL `hash`)."""
    return HashingTF(numFeatures=num_features).indexOf(term)
