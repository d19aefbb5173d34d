"""Document quality: random Fourier features of text statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

import string
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents, materialize, send_code
from .hostrules import repeated_window_words

MARKS = b"#*$%&|<>"  # fixed values, as in the quality rules
FEATURES = 14


def features(text: str) -> list[float]:
    """Statistics of one text; an empty one gives zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * FEATURES
    different = len(set(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    letters = sum(map(len, words))
    many = lambda drop: len(raw) - len(raw.translate(None, drop))
    return [np.log1p(n), letters / n, different / n, repeated_window_words(words) / n,
            many(MARKS) / n, many(b"!?") / n, many(string.ascii_uppercase.encode()) / chars,
            many(string.digits.encode()) / chars, many(b".,;:") / n, 1 - len(set(lines)) / len(lines),
            n / len(lines) / (n / len(lines) + 20), sum(a == b for a, b in zip(words, words[1:])) / n,
            many(b"|") / n, max(map(len, words)) / (max(map(len, words)) + 30)]


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # ridge scores and
    levels: np.ndarray  # their calibrated values, both rising

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return lift((x - self.mean) / self.scale, self.directions, self.phases) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.ridge(x), self.steps, self.levels)


def lift(x: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """sqrt(2/D) cos(xW + b), whose products approximate a Gaussian kernel, and a constant."""
    z = np.sqrt(2 / len(phases)) * np.cos(np.clip(x, -8, 8) @ directions + phases)
    return np.hstack([z, np.ones((len(x), 1))])


def isotonic(values: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (score, weight, positives) by rising score: steps and rising levels. Each
    block's rate is pulled to the overall one by one pseudo-row, so that a small block is not certain."""
    overall = sum(p for _, _, p in values) / max(sum(w for _, w, _ in values), 1)
    blocks: list[list[float]] = []
    for score, weight, positive in values:
        blocks.append([score * weight, weight, positive, score, score])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            s, w, p, _, high = blocks.pop()
            last = blocks[-1]
            blocks[-1] = [last[0] + s, last[1] + w, last[2] + p, last[3], high]
    levels = np.maximum.accumulate([(p + overall) / (w + 1) for _, w, p, _, _ in blocks])
    steps = np.array([x for b in blocks for x in (b[3], b[4])])
    return steps, np.clip(np.repeat(levels, 2), 0, 1)


def text_features(docs: DataFrame) -> DataFrame:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    return documents(docs).withColumn("x", measure("text")).select("doc_id", "x")


def matrix(xs) -> np.ndarray:
    return np.array(xs.tolist(), np.float64).reshape(len(xs), -1)


def fit(rows: DataFrame, dims: int = 256, width: float = 3.0, ridge: float = 1e-2, max_rows: int = 200_000, seed: int = 11) -> Model:
    """A model from rows (doc_id, x, y of 0/1).

    Training takes all rows up to `max_rows`, beyond that the ones first in the order of a hash of their ids. Four
    fifths of them give the normal equations: every partition sums z z' and z y of its rows, and Spark adds these
    sums row by row of the matrix. The last fifth calibrates the ridge scores. Only sums and score counts reach the driver.
    Without two classes in the labels the model gives their rate (0.5 without labels).
    """
    spark = rows.sparkSession
    chosen = rows.withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
    if chosen.count() > max_rows:
        chosen = chosen.orderBy("h").limit(max_rows)
    chosen = materialize(chosen.repartition(32, "h"), "training")
    one = [F.avg(F.col("x")[i]) for i in range(FEATURES)] + [F.stddev_pop(F.col("x")[i]) for i in range(FEATURES)]
    n, rate, *moments = chosen.agg(F.count(F.lit(1)), F.avg("y"), *one).first()
    rng = np.random.default_rng(seed)
    directions, phases = rng.normal(0, 1 / width, (FEATURES, dims)), rng.uniform(0, 2 * np.pi, dims)
    if not n or rate in (0.0, 1.0):
        flat = np.full(2, 0.5 if not n else float(rate))
        return Model(np.zeros(FEATURES), np.ones(FEATURES), directions, phases, np.zeros(dims + 1), np.array([0.0, 1.0]), flat)
    mean, scale = np.array(moments[:FEATURES]), np.maximum(np.array(moments[FEATURES:]), 1e-6)
    part = F.pmod(F.shiftright("h", 8), F.lit(5))

    def sums(batches):
        total = np.zeros((dims + 1, dims + 2))
        for b in batches:
            z = lift((matrix(b["x"]) - mean) / scale, directions, phases)
            total += z.T @ np.hstack([z, b["y"].to_numpy(np.float64)[:, None]])
        yield pd.DataFrame({"i": np.arange(dims + 1), "row": list(total)})

    cells = chosen.filter(part < 4).select("x", "y").mapInPandas(sums, "i int, row array<double>")
    whole = cells.groupBy("i").agg(F.array(*[F.sum(F.col("row")[j]) for j in range(dims + 2)]).alias("row")).orderBy("i").collect()
    total = np.array([r["row"] for r in whole]).reshape(dims + 1, dims + 2)
    gram = total[:, :-1] + ridge * total[-1, -2] / dims * np.diag(np.append(np.ones(dims), 0))
    model = Model(mean, scale, directions, phases, np.linalg.lstsq(gram, total[:, -1], rcond=None)[0], np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    @F.pandas_udf("double")
    def ridge_score(x: pd.Series) -> pd.Series:
        return pd.Series(np.round(model.ridge(matrix(x)), 3))

    counts = (chosen.filter(part == 4).select(ridge_score("x").alias("s"), "y").groupBy("s")
              .agg(F.count(F.lit(1)).alias("w"), F.sum("y").alias("p")).orderBy("s").collect())
    steps, levels = isotonic([(r["s"], float(r["w"]), float(r["p"])) for r in counts]) if counts else (model.steps, model.levels)
    return model._replace(steps=steps, levels=levels)


def score(scored: DataFrame, model: Model) -> DataFrame:
    @F.pandas_udf("double")
    def value(x: pd.Series) -> pd.Series:
        return pd.Series(np.clip(model.score(matrix(x)), 0, 1))

    return scored.withColumn("score", value("x"))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`.

    The texts are read once; what is kept of each are its statistics. Labels are learned from rows where `held_out`
    (an expression over doc_id) is false. Inputs are the statistics alone.

    Null or empty text: all statistics zero, scored like any other. Null doc_id: scored, never a training row,
    held_out false. Null labels and labels of unknown documents are not used; of several labels of a document the
    smallest counts. Repeated rows are scored each. Empty tables: no rows, or the flat score of `fit`.
    """
    send_code(docs.sparkSession)
    rows = materialize(text_features(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False))), "features")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y")))
    model = fit(rows.filter("not held_out").join(known, "doc_id").select("doc_id", "x", "y"), **options)
    scored = score(rows, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"))
