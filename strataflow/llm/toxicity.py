"""Toxicity categories by a classifier chain of linear models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import documents, written

#: Chain order: name and condition on the columns of the label table.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
#: Labelled rows the models are fitted on at most; the ones of least hash are taken.
TRAIN_ROWS = 20_000
#: Terms a model knows at most, the most frequent ones of the labelled rows.
VOCABULARY = 1 << 14
#: Terms of fewer labelled rows are left out, whatever the size of the sample.
MIN_DOCUMENTS = 3
PREFIXES = (4, 5)
FOLDS = 2
THRESHOLD = 0.3
ITERATIONS = 30
PENALTY = 5e-4


def terms(text: Column) -> Column:
    """Words in lower case, the beginnings of longer words, which catch inflections, and style."""
    text = F.coalesce(text, F.lit(""))
    found = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    starts = (_beginnings(found, n) for n in PREFIXES)
    # two marks of style, in steps: how much is not letters, and how few of the words are different ones
    length = F.greatest(F.length(text), F.lit(1))
    signs = F.floor(20 * F.length(F.regexp_replace(text, r"[\p{L}\s]+", "")) / length)
    variety = F.floor(20 * F.size(F.array_distinct(found)) / F.greatest(F.size(found), F.lit(1)))
    style = F.array(F.concat(F.lit("~signs "), signs), F.concat(F.lit("~variety "), variety))
    return F.concat(found, *starts, style)


def _beginnings(found: Column, n: int) -> Column:
    """The first ``n`` letters of each longer word, marked as such."""
    longer = F.filter(found, lambda w: F.length(w) > n)
    return F.transform(longer, lambda w: F.concat(F.lit("^"), F.substring(w, 1, n)))


def _fit(rows: DataFrame, label: str, features: str):
    """A sparse logistic model, or the share of positives if only one class occurs."""
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0.0))).first()
    if positive in (0, total):
        return positive / total if total else 0.0
    return LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=ITERATIONS, regParam=PENALTY, elasticNetParam=1.0,
        predictionCol="_class", rawPredictionCol="_margin", probabilityCol="_probability",
    ).fit(rows)


def _predict(model, rows: DataFrame, out: str) -> DataFrame:
    if isinstance(model, float):
        return rows.withColumn(out, F.lit(model))
    done = model.transform(rows).withColumn(out, vector_to_array("_probability")[1])
    return done.drop("_class", "_margin", "_probability")


def _extend(rows: DataFrame, probability: str, features: str, out: str) -> DataFrame:
    """Append an earlier category's probability to the features."""
    return VectorAssembler(inputCols=[features, probability], outputCol=out).transform(rows)


@dataclass
class Chain:
    """Fitted models, in chain order."""

    names: list[str]
    vectorizer: CountVectorizerModel | None
    models: list

    def transform(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``p_<category>`` for each category; a null text is an empty one.

        Without any labelled row there is no model and each probability is null.
        Columns of these names are replaced.
        """
        probabilities = [f"p_{n}" for n in self.names]
        rows = docs.drop(*probabilities)
        if self.vectorizer is None:
            return rows.withColumns({p: F.lit(None).cast("double") for p in probabilities})
        rows = rows.select(F.struct("*").alias("_doc"), terms(F.col("text")).alias("_terms"))  # no name can clash
        rows = self.vectorizer.transform(rows)
        features = "_features"
        for i, (probability, model) in enumerate(zip(probabilities, self.models)):
            rows = _predict(model, rows, probability)
            if i + 1 < len(self.models):
                rows = _extend(rows, probability, features, f"_features{i}")
                features = f"_features{i}"
        return rows.select("_doc.*", *probabilities)


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories=CATEGORIES, train_rows: int = TRAIN_ROWS, folds: int = FOLDS
) -> Chain:
    """Fit a model per category on the features and the earlier categories' probabilities.

    For its training rows an earlier category's probability is predicted by a
    model of the other folds, so later models see errors as they will be. Labels
    of a repeated doc_id are united (a category holds if any row says so); rows
    whose doc_id is null or that miss a label used here are left out.
    """
    names = [n for n, _ in categories]
    held = labels.select("doc_id", *(F.expr(f"CAST({rule} AS DOUBLE)").alias(f"y_{n}") for n, rule in categories))
    united = held.dropna().groupBy("doc_id").agg(*(F.max(f"y_{n}").alias(f"y_{n}") for n in names))
    order = F.xxhash64(F.col("doc_id").cast("bigint"))
    sample = united.orderBy(order, "doc_id").limit(train_rows)
    # at most train_rows rows, so the documents' texts need no shuffle
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = written(
        rows.select(F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds)).alias("_fold"), terms(F.col("text")).alias("_terms"),
                    *(f"y_{n}" for n in names)),
        "toxicity-sample",
    )
    if not rows.limit(1).count():
        return Chain(names, None, [])
    frequency = rows.select(F.explode(F.array_distinct("_terms")).alias("term")).groupBy("term").count()
    top = frequency.where(F.col("count") >= MIN_DOCUMENTS).orderBy(F.desc("count"), "term").limit(VOCABULARY).collect()
    # and a term that no text has, as a model needs a feature
    vectorizer = CountVectorizerModel.from_vocabulary([*(r.term for r in top), ""], "_terms", "_features").setBinary(True)
    # the sample is bounded, and with few partitions a step of the fit is one short stage
    rows = vectorizer.transform(rows).drop("_terms").repartition(4).persist()
    kept = [rows]
    models, features = [], "_features"
    for i, name in enumerate(names):
        models.append(_fit(rows, f"y_{name}", features))
        if i + 1 == len(names):
            break
        parts = []
        for fold in range(folds):
            other = _fit(rows.where(F.col("_fold") != fold), f"y_{name}", features)
            parts.append(_predict(other, rows.where(F.col("_fold") == fold), f"p_{name}"))
        united_parts = parts[0]
        for part in parts[1:]:
            united_parts = united_parts.unionByName(part)
        rows = _extend(united_parts, f"p_{name}", features, f"_features{i}").drop(features).persist()
        kept.append(rows)
        features = f"_features{i}"
    for sample_rows in kept:
        sample_rows.unpersist()
    return Chain(names, vectorizer, models)


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the category probabilities and ``toxic``, true from ``threshold`` on."""
    scored = fit_chain(docs, labels).transform(docs.drop("toxic"))
    return scored.withColumn("toxic", F.coalesce(F.col("p_toxic") >= threshold, F.lit(False)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_documents(documents(spark, sf_dir), labels).select("doc_id", "p_low_quality", "p_toxic", "toxic")
