"""Intent classification: majority baseline, linear models on TF-IDF blocks, top-2 post-processing.

Fitting uses Spark ML on the training rows, as many as there are. Scoring needs no vectors: the coefficients are
a small table (block, term -> idf, one number per class), and a message's scores are sums over the
rows of its terms.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, Window, functions as F

from .. import values as V
from ..functions import text as X
from ..session import is_small, materialize, measured, size_measures
from .features import Analyzer, idf, raw_weights, term_counts, vocabulary
from .labels import taxonomy_join

def hybrid_blocks(word_terms: int | None = V.CLASSIFIER_WORD_TERMS, char_terms: int | None = V.CLASSIFIER_CHAR_TERMS):
    """Feature blocks of the hybrid model; the sizes bound its coefficient table. None keeps all terms."""
    return [("word", Analyzer("word", 1, 3, True, X.TOKEN, word_terms)),
            ("char", Analyzer("char_wb", 3, 5, False, X.TOKEN, char_terms))]


def baseline_blocks(terms: int | None = V.BASELINE_TERMS):
    return [("word", Analyzer("word", 1, 2, True, X.TOKEN_PLAIN, terms))]


HYBRID_BLOCKS, BASELINE_BLOCKS = hybrid_blocks(), baseline_blocks()

TOLERANCE = 1e-9  # of the loss, relative; leaves no entry of its gradient above 1e-4 (see `optimality`)

METHOD_HYBRID = "proposed_hybrid_calibrated"
METHOD_BASELINE = "tfidf_logistic_regression"
METHOD_MAJORITY = "majority_baseline"


def majority_label(labels: DataFrame, label: str) -> DataFrame:
    """One row: the most frequent label and its share; the fixed default when there are no labels."""
    name, share = V.MAJORITY_DEFAULT
    counts = labels.groupBy(F.col(label).alias("intent")).agg(F.count(F.lit(1)).alias("n"))
    # the largest count wins, then the smaller label
    return counts.agg(F.min_by("intent", F.struct(-F.col("n"), "intent")).alias("i"), F.max("n").alias("top"),
                      F.sum("n").alias("total")).select(
        F.coalesce("i", F.lit(name)).alias("intent"),
        F.round(F.coalesce(F.col("top") / F.col("total"), F.lit(share)), 4).alias("confidence"))


def majority_baseline(df: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Predict the majority label for every row."""
    best = majority_label(labels, label).select(F.struct("intent", "confidence")).scalar()
    return df.withColumn("_best", best).select(
        "*", "_best.intent", "_best.confidence", F.lit(METHOD_MAJORITY).alias("method")).drop("_best")


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per class
    return counts.withColumn("weight", F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n")))


@dataclass
class LinearModel:
    """classes, intercepts and the table terms(block, term, idf, coef array)."""

    classes: list[str]
    intercepts: list[float]
    terms: DataFrame
    blocks: list[tuple[str, Analyzer]]
    method: str
    small_terms: bool  # measured: may the table be broadcast
    penalty: float = 0.0  # of half the squared coefficients, beside the mean loss


def _block_vocabularies(docs: DataFrame, doc: str, text: str, blocks, documents: int) -> tuple[DataFrame, dict]:
    """(block, term, idf, feature) over all blocks, features numbered through, and the table's size."""
    tables = None
    for name, analyzer in blocks:
        table = idf(vocabulary(term_counts(docs, doc, text, analyzer), analyzer.max_features), documents).select(
            F.lit(name).alias("block"), "term", "idf")
        tables = table if tables is None else tables.unionByName(table)
    # numbered in one place: the vocabularies have fixed maximum sizes
    numbered = tables.withColumn("feature", F.row_number().over(Window.orderBy("block", "term")) - 1)
    return measured(numbered, "terms", **size_measures(numbered))


def block_rows(docs: DataFrame, doc: str, text: str, blocks, terms: DataFrame, how: str, small: bool) -> list[DataFrame]:
    """Per feature block: (doc, term, raw weight, further columns of `terms`), still spread by document."""
    return [raw_weights(term_counts(docs, doc, text, analyzer), terms.filter(F.col("block") == name).drop("block"),
                        how, small) for name, analyzer in blocks]


def unit_vectors(docs: DataFrame, doc: str, text: str, blocks, terms: DataFrame, small: bool) -> DataFrame:
    """(doc, features, weights): the stacked blocks, each of unit length per document."""
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
    scaled = [rows.groupBy(doc).agg(F.collect_list(F.struct("feature", "raw")).alias("entries"), length.alias("l"))
              .select(doc, F.transform("entries", lambda e: F.struct(
                  e["feature"].alias("feature"), (e["raw"] / F.col("l")).alias("weight"))).alias("entries"))
              for rows in block_rows(docs, doc, text, blocks, terms, "inner", small)]
    merged = reduce(DataFrame.unionByName, scaled).groupBy(doc).agg(
        F.array_sort(F.flatten(F.collect_list("entries"))).alias("entries"))
    return merged.select(doc, F.col("entries.feature").alias("features"), F.col("entries.weight").alias("weights"))


def fit_linear(docs: DataFrame, doc: str, text: str, label: str, blocks, c: float, max_iter: int,
               method: str) -> LinearModel:
    """Multinomial logistic regression with balanced class weights and an L2 penalty of 1/(c*n).

    All rows of `docs` are learnt from. They are written once, because several passes follow.
    """
    docs, seen = measured(docs.select(doc, text, label), "training", rows=F.count(F.lit(1)))
    spark, n = docs.sparkSession, seen["rows"]
    if n == 0:
        raise ValueError("the training data is empty")
    weights = balanced_weights(docs, label).orderBy(label).collect()  # one row per class
    classes = [r[label] for r in weights]
    terms, sizes = _block_vocabularies(docs, doc, text, blocks, n)
    size = sizes["rows"]
    # only the training rows become vectors; no built-in function makes sparse ones
    to_vector = F.udf(lambda i, w: Vectors.sparse(size, i, w), VectorUDT())
    code = spark.createDataFrame([(r[label], float(k), float(r["weight"])) for k, r in enumerate(weights)],
                                 f"`{label}` string, label_code double, class_weight double")
    rows = (docs.select(doc, label).join(unit_vectors(docs, doc, text, blocks, terms, is_small(sizes)), doc,
                                             "left")
            .join(F.broadcast(code), label)
            .select("label_code", "class_weight", to_vector(
                F.coalesce("features", F.array().cast("array<int>")),
                F.coalesce("weights", F.array().cast("array<double>"))).alias("features")))
    # every iteration is one job over all partitions, so there are only as many as the rows need
    parts = max(1, min(64, n // 2000))
    rows = rows.repartition(parts).persist()
    if len(classes) == 1:
        coef, intercepts = [[0.0] * size], [0.0]
    else:
        model = LogisticRegression(
            featuresCol="features", labelCol="label_code", weightCol="class_weight", family="multinomial",
            regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter,
            tol=TOLERANCE, aggregationDepth=2 if parts <= 16 else 3).fit(rows)  # few gradients reach the driver
        coef, intercepts = model.coefficientMatrix.toArray(), [float(b) for b in model.interceptVector.toArray()]
    rows.unpersist()
    # bounded by the vocabulary caps and the number of classes
    table = spark.createDataFrame([(j, [float(coef[k][j]) for k in range(len(classes))]) for j in range(size)],
                                  "feature int, coef array<double>")
    weighted = terms.join(table, "feature").select("block", "term", "idf", "coef")
    weighted, sizes = measured(weighted, "model", **size_measures(weighted.drop("coef")))
    sizes["bytes"] = (sizes["bytes"] or 0) + size * len(classes) * 8
    return LinearModel(classes, intercepts, weighted, blocks, method, is_small(sizes), 1.0 / (c * n))


def fit_hybrid(docs: DataFrame, doc: str, text: str, label: str, blocks=None) -> LinearModel:
    """Word 1-3 grams and in-word character 3-5 grams; `blocks` as from `hybrid_blocks` sets other sizes."""
    return fit_linear(docs, doc, text, label, blocks or HYBRID_BLOCKS, 3.5, 1500, METHOD_HYBRID)


def fit_baseline(docs: DataFrame, doc: str, text: str, label: str, blocks=None) -> LinearModel:
    """Word 1-2 grams only; `blocks` as from `baseline_blocks` sets another size."""
    return fit_linear(docs, doc, text, label, blocks or BASELINE_BLOCKS, 2.0, 1000, METHOD_BASELINE)


def class_scores(df: DataFrame, doc: str, text: str, model: LinearModel) -> DataFrame:
    """Add `scores`: an array of (probability, intent), most probable first."""
    k = len(model.classes)
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
    parts = [rows.groupBy(doc).agg(*[(F.sum(F.col("raw") * F.col("coef")[i]) / length).alias(f"s{i}") for i in range(k)])
             for rows in block_rows(df, doc, text, model.blocks, model.terms, "left", model.small_terms)]
    sums = reduce(DataFrame.unionByName, parts).groupBy(doc).agg(
        *[F.coalesce(F.sum(f"s{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(k)])
    logits = [F.col(f"s{i}") + F.lit(model.intercepts[i]) for i in range(k)]
    top = F.greatest(*logits) if k > 1 else logits[0]
    exps = sums.select(doc, *[F.exp(z - top).alias(f"e{i}") for i, z in enumerate(logits)])
    total = sum((F.col(f"e{i}") for i in range(k)), F.lit(0.0))
    scores = F.array(*[F.struct((F.col(f"e{i}") / total).alias("probability"), F.lit(name).alias("intent"))
                       for i, name in enumerate(model.classes)])
    return df.join(exps.select(doc, F.sort_array(scores, asc=False).alias("scores")), doc)


def optimality(docs: DataFrame, doc: str, text: str, label: str, model: LinearModel) -> DataFrame:
    """One row per class of a fitted model: documents, class_weight, mass (the class weights of the training rows times the
    probabilities the model gives the class) and gradient, the largest absolute entry of the penalised loss's gradient for the class.

    `docs` are the training rows. At the optimum the gradient is zero, and, as intercepts carry no penalty, the mass is what the class's
    own rows weigh: documents * class_weight. Residuals are one row per document; they meet the document's terms in a join
    and are added up per term before anything is compared.
    """
    k = len(model.classes)
    weights = balanced_weights(docs, label)
    scored = class_scores(docs, doc, text, model).join(F.broadcast(weights), label)  # one row per class
    chance = F.map_from_entries(F.transform("scores", lambda s: F.struct(s["intent"], s["probability"])))
    rows = materialize(scored.select(doc, label, "weight", *[(F.col("weight") * chance[c]).alias(f"p{i}") for i, c in enumerate(model.classes)],
                                     *[(F.col("weight") * (chance[c] - (F.col(label) == c).cast("int"))).alias(f"r{i}")
                                       for i, c in enumerate(model.classes)]), "residuals")
    total = F.sum("weight").alias("total")
    masses = rows.agg(total, *[F.sum(f"p{i}").alias(f"p{i}") for i in range(k)], *[F.sum(f"r{i}").alias(f"r{i}") for i in range(k)])
    residuals = rows.select(doc, *[f"r{i}" for i in range(k)])
    steep = None
    for entries in block_rows(docs, doc, text, model.blocks, model.terms, "inner", model.small_terms):
        length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))
        sums = (entries.withColumn("x", F.col("raw") / length).join(residuals, doc).groupBy("term", "coef")
                .agg(*[F.sum(F.col("x") * F.col(f"r{i}")).alias(f"g{i}") for i in range(k)]))
        steep = sums.drop("term") if steep is None else steep.unionByName(sums.drop("term"))
    part = steep.crossJoin(F.broadcast(masses.select("total")))  # one row
    highest = part.agg(*[F.max(F.abs(F.col(f"g{i}") / F.col("total") + F.lit(model.penalty) * F.col("coef")[i])).alias(f"g{i}") for i in range(k)])
    both = masses.crossJoin(F.broadcast(highest))  # one row each
    entry = [F.struct(F.lit(c).alias(label), F.col(f"p{i}").alias("mass"),
                      F.greatest(F.abs(F.col(f"r{i}") / F.col("total")), F.coalesce(f"g{i}", F.lit(0.0))).alias("gradient"))
             for i, c in enumerate(model.classes)]
    found = both.select(F.explode(F.array(*entry)).alias("e")).select("e.*")
    return found.join(F.broadcast(weights), label).select(label, F.col("n").alias("documents"), F.col("weight").alias("class_weight"), "mass", "gradient")


def predict_top2(df: DataFrame, scores: str = "scores", margin: float = V.AMBIGUITY_MARGIN) -> DataFrame:
    """Intent, confidence, margin and ambiguity from an array of (probability, intent).

    Equal probabilities go to the later name. The margin test uses the unrounded difference.
    """
    ranked = F.sort_array(scores, asc=False)
    first = ranked[0]
    second = F.coalesce(F.get(ranked, F.lit(1))["probability"], F.lit(0.0))
    gap = first["probability"] - second
    return df.withColumns({
        "intent": first["intent"],
        "confidence": F.round(first["probability"], 4),
        "margin": F.round(gap, 4),
        "is_ambiguous": gap < margin,
    })


def class_probabilities(df: DataFrame, scores: str = "scores") -> DataFrame:
    """A map intent -> probability with 4 decimals, most probable first."""
    return df.withColumn("all_probabilities", F.map_from_entries(F.transform(
        F.sort_array(scores, asc=False), lambda s: F.struct(s["intent"], F.round(s["probability"], 4)))))


def triggered_keywords(df: DataFrame, text: str, taxonomy: DataFrame, intent: str = "intent") -> DataFrame:
    """The first five distinct long words of the intent's example sentences that occur in the text."""
    words = F.filter(F.split(F.lower(F.array_join("examples", " ")), rf"[{X.SPACE}]+"), lambda w: F.length(w) > 3)
    side = F.broadcast(taxonomy.select(F.col("name").alias(intent), F.array_distinct(words).alias("_words")))
    hits = F.slice(F.filter("_words", lambda w: F.contains(F.lower(F.col(text)), w)), 1, 5)
    return (df.join(side, intent, "left")
            .withColumn("triggered_keywords", F.coalesce(hits, F.array().cast("array<string>"))).drop("_words"))


def predict(df: DataFrame, doc: str, text: str, model: LinearModel, taxonomy: DataFrame,
            margin: float = V.AMBIGUITY_MARGIN) -> DataFrame:
    """All prediction columns for a table of messages."""
    scored = class_scores(df.withColumn("_lower", F.lower(F.coalesce(text, F.lit("")))), doc, "_lower", model)
    labelled = taxonomy_join(predict_top2(scored, "scores", margin), taxonomy)
    labelled = triggered_keywords(class_probabilities(labelled), "_lower", taxonomy)
    return labelled.withColumn("method", F.lit(model.method)).drop("scores", "_lower")
