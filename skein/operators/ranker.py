"""Sentence ranker (SU3): a supervised re-aim of summariser fine-tuning.

Features of a sentence: relative position, number of word tokens, their mean
idf, the TF-IDF cosine between sentence and document, and the share of its
words that begin with a capital. Label 1 is the sentence with the highest
ROUGE-1 F against the reference summary (the first of equals). Spark ML
logistic regression is trained on the train documents of an exact split; the
documents held out are scored and evaluated as a ranking.

The cosine needs no vectors: with c the count of a term in a sentence, t in
the document and w its idf, the product of both is the sum of c t w w, and
the document's squared length is the sum of that over its sentences. So the
sums of ``sentence_sums`` give every feature of the terms.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions.tokens import let, sentences, tokens
from skein.operators.prep import split_exact
from skein.operators.quality import rouge1_each
from skein.operators.summarise import Summariser, document_idf, sentence_sums
from skein.sources.io import load_model, save_model
from skein.session import written

FEATURES = ["rel_pos", "n_tokens", "mean_idf", "cosine", "capitals"]


def sentence_features(df: DataFrame, key: str, text: str, summary: str | None, idf: DataFrame | None = None) -> DataFrame:
    """(key, spos, *FEATURES, rouge1, label), the last two null without a
    ``summary``; ``idf`` (term, idf) may come from other documents, a term that
    it lacks weighs nothing. ``key`` names one document each; a document without
    sentences has no rows."""
    idf = document_idf(df, text) if idf is None else idf

    def capitals(x):
        return let(lambda y: F.size(F.filter(y["words"], lambda z: z.rlike(r"^\p{Lu}"))) / F.greatest(F.size(y["words"]), F.lit(1)),
                   words=tokens(x))

    def carry(s):
        made = F.arrays_zip(s.alias("s"), F.coalesce(F.col("__rouge1"), F.array().cast("array<double>")).alias("rouge1"))
        return let(lambda y: F.transform(y["made"], lambda x, i: F.struct(
            F.round(x["rouge1"], 6).alias("rouge1"), F.round(capitals(x["s"]), 6).alias("capitals"),
            F.round(i / F.size(y["made"]), 6).alias("rel_pos"))), made=made)

    against = F.lit(None).cast("array<double>") if summary is None else rouge1_each(F.col(summary), sentences(F.col(text)))
    docs = df.select(key, text, against.alias("__rouge1"))
    sums = sentence_sums(docs, key, text, idf, carry)
    # The label, a document's first sentence of the highest ROUGE-1, is found in its row.
    best = F.array_sort(F.transform("s", lambda x, i: F.named_struct(
        F.lit("order"), F.negative(x["e"]["rouge1"]), F.lit("spos"), x["spos"], F.lit("i"), i)))[0]["i"]
    labelled = let(lambda y: F.transform(y["s"], lambda x, i: F.struct(x.alias("x"), F.when(x["e"]["rouge1"].isNotNull(), (i == y["best"]).cast("double")).alias("label"))),
                   s=F.col("s"), best=best)
    rows = sums.select(key, "whole", F.explode_outer(labelled).alias("y")).select(key, "whole", "y.x", "y.label")
    found = F.when(F.col(key).isNotNull(), F.col("x"))   # the terms of a null key are no document's
    cosine = F.when((found["own"] > 0) & (F.col("whole") > 0), found["both"] / F.sqrt(found["own"] * F.col("whole"))).otherwise(0.0)
    return rows.select(
        key, "x.spos", "x.e.rel_pos", F.coalesce(found["n"], F.lit(0)).cast("double").alias("n_tokens"),
        F.round(F.when(found["n"] > 0, found["mass"] / found["n"]).otherwise(F.lit(0.0)), 6).alias("mean_idf"),
        F.round(F.coalesce(cosine, F.lit(0.0)), 6).alias("cosine"), "x.e.capitals", "x.e.rouge1", "label")


def fit_on(docs: DataFrame, key: str, text: str, summary: str, idf: DataFrame):
    """The ranker's pipeline, fitted on all sentences of ``docs``."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"),
                            LogisticRegression(maxIter=20, featuresCol="features", labelCol="label")])
    # The fit reads its rows more than once: the features are made once and kept.
    return pipe.fit(written(sentence_features(docs, key, text, summary, idf).select(*FEATURES, "label"), "features"))


def fit_sentence_ranker(df: DataFrame, key: str, text: str, summary: str, test: float = 0.2, seed: int = 42):
    """Returns (model, scored test sentences with ``rouge1``, ``label`` and
    ``p`` = probability of label 1)."""
    train_docs, test_docs = split_exact(df.select(key, text, summary), key, test, seed)
    idf = document_idf(train_docs, text)   # of the train documents, for both
    model = fit_on(train_docs, key, text, summary, idf)
    scored = model.transform(sentence_features(test_docs, key, text, summary, idf))
    return model, scored.select(key, "spos", "rouge1", "label", vector_to_array("probability")[1].alias("p"))


def ranking_evaluation(scored: DataFrame, key: str) -> DataFrame:
    """One row over the documents of ``scored``: ``n``, ``accuracy_at_1``
    (share of them whose top sentence is the labelled one) and the mean
    ROUGE-1 F of the top sentence, of the first one (lead-1) and of the best."""
    top = F.max_by(F.struct("rouge1", "label"), F.struct("p", -F.col("spos")))
    lead = F.min_by("rouge1", "spos")
    docs = scored.groupBy(key).agg(top.alias("top"), lead.alias("lead"), F.max("rouge1").alias("best"))
    return docs.agg(F.count(F.lit(1)).alias("n"), F.avg("top.label").alias("accuracy_at_1"), F.avg("top.rouge1").alias("rouge1_top"),
                    F.avg("lead").alias("rouge1_lead1"), F.avg("best").alias("rouge1_best"))


def save_ranker(model, idf: DataFrame, path: str) -> None:
    """A fitted ranker as a model in a (shared) folder: the pipeline (IO8) and its idf table."""
    save_model(model, f"{path}/pipeline")
    idf.write.mode("overwrite").parquet(f"{path}/idf")


def load_ranker(spark: SparkSession, path: str, k: int = 3) -> Summariser:
    """A summariser from that folder: the ``k`` sentences with the highest
    probability (ties: the earlier one), in document order. A null or empty
    text has an empty summary; ``key`` names one document each."""
    model, idf = load_model(f"{path}/pipeline"), spark.read.parquet(f"{path}/idf")

    def run(df: DataFrame, key: str, text: str) -> DataFrame:
        scored = model.transform(sentence_features(df.select(key, text), key, text, None, idf)).select(
            key, "spos", vector_to_array("probability")[1].alias("p"))
        best = Window.partitionBy(key).orderBy(F.col("p").desc(), F.col("spos"))
        top = (scored.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k)
               .groupBy(key).agg(F.array_sort(F.collect_list("spos")).alias("__at")))
        picked = F.transform(F.col("__at"), lambda i: F.get(F.col("__s"), i))
        return (df.select(key, sentences(F.col(text)).alias("__s")).join(top, key, "left")
                .select(key, F.coalesce(F.array_join(picked, " "), F.lit("")).alias("summary")))
    return run
