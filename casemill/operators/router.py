"""Routing classifier: balanced multinomial logistic regression on TF-IDF features, fitted until its gradient vanishes."""

from __future__ import annotations

import warnings
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.operators import classification, lowrank, tfidf
from casemill.operators.tfidf import ROUTER, TfidfSpec
from casemill.session import discard, materialize

MEMORY = 10  # steps the optimiser remembers
TRIES = 20  # shortenings of a step


@dataclass(frozen=True)
class Router:
    """Terms with their idf, a coefficient for every term and class (the last row is the constant), class names, and the reports.

    The vocabulary has at most ``max_features`` terms, so the model has a bound and travels to the tasks.
    """

    terms: list[str]
    idf: np.ndarray
    coefficients: np.ndarray
    classes: list[str]
    spec: TfidfSpec
    converged: bool
    gradient: float
    report: DataFrame | None = None
    class_report: DataFrame | None = None

    def predict(self, docs: DataFrame, text: str = "clean_narrative") -> DataFrame:
        """``docs`` with the predicted class as ``prediction``; texts are split and scored where they lie."""
        kept = [c for c in docs.columns if c != "prediction"]
        stop_words = self.spec.stop_words

        def counting() -> Callable[[pa.RecordBatch], tuple]:
            count = tfidf.TermCounter(stop_words)
            return lambda part: tfidf.counted(pa.RecordBatch.from_arrays([*count(part.column(part.num_columns - 1))], names=["terms", "tf"]))

        return self.classified(docs.select(*kept, F.lower(text).alias("lowered")), kept, counting)

    def predict_counted(self, counts: DataFrame) -> DataFrame:
        """:meth:`predict` for documents whose terms are counted: their other columns and the prediction."""
        return self.classified(counts, counts.columns[:-2], lambda: tfidf.counted)

    def classified(self, rows: DataFrame, kept: list[str], counting: Callable[[], Callable[[pa.RecordBatch], tuple]]) -> DataFrame:
        """The first columns of the rows with their class; a task makes its own counter of the others."""
        shared = rows.sparkSession.sparkContext.broadcast((self.terms, self.idf, self.coefficients, self.classes))
        sublinear = self.spec.sublinear

        def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms, idf, coefficients, classes = shared.value
            counted, weigh, names = counting(), tfidf.Weigher(terms, idf, sublinear), pa.array(classes, pa.string())
            for part in tfidf.sliced(batches):
                offsets, idx, x = weigh(*counted(part))
                scores = np.tile(coefficients[-1], (part.num_rows, 1))
                full = np.flatnonzero(np.diff(offsets))
                if full.size:
                    scores[full] += np.add.reduceat(coefficients[idx] * x[:, None], offsets[full], axis=0)
                best = names.take(pa.array(scores.argmax(axis=1)))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], best], names=[*kept, "prediction"])

        fields = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in kept)
        return rows.mapInArrow(body, f"{fields}, prediction string")

    def write(self, spark: SparkSession, path: str) -> None:
        """A row per term and one for the constant; classes and state in each row's file metadata would get lost, so they are a table of their own."""
        rows = [(t, float(i), [float(c) for c in w]) for t, i, w in zip([*self.terms, None], [*self.idf, 0.0], self.coefficients)]
        spark.createDataFrame(rows, "term string, idf double, coefficients array<double>").write.mode("overwrite").parquet(f"{path}/terms")
        spark.createDataFrame([(self.classes, self.converged, self.gradient)], "classes array<string>, converged boolean, gradient double").write.mode("overwrite").parquet(f"{path}/model")


def open_router(spark: SparkSession, path: str, spec: TfidfSpec = ROUTER) -> Router:
    rows = spark.read.parquet(f"{path}/terms").orderBy(F.asc_nulls_last("term")).collect()  # at most max_features rows
    model = spark.read.parquet(f"{path}/model").first()
    return Router([r["term"] for r in rows[:-1]], np.array([r["idf"] for r in rows[:-1]]), np.array([r["coefficients"] for r in rows]), model["classes"], spec,
                  model["converged"], model["gradient"])


def carried_over(start: Router, terms: list[str], classes: list[str]) -> np.ndarray:
    """Coefficients of an earlier model for the terms and classes it shares with a new one; 0 elsewhere."""
    result = np.zeros((len(terms) + 1, len(classes)))
    row = {t: i for i, t in enumerate(start.terms)}
    new, old = (list(x) for x in zip(*[(i, row[t]) for i, t in enumerate(terms) if t in row], (len(terms), len(start.terms))))
    for j, c in enumerate(classes):
        if c in start.classes:
            result[new, j] = start.coefficients[old, start.classes.index(c)]
    return result


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, float]:
    """The minimum of a smooth convex function and the largest entry of its gradient there, by limited-memory quasi-Newton steps.

    Ends when no entry of the gradient exceeds ``tol``, which certifies the result whatever the number of steps. Every call of ``value`` is a pass over the data.
    """
    at, (now, slope) = start, value(start)
    steps: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=MEMORY)
    for _ in range(max_iter):
        if np.abs(slope).max() <= tol:
            break
        direction = -slope
        parts = []
        for moved, turned, scale in reversed(steps):
            part = scale * (moved * direction).sum()
            direction = direction - part * turned
            parts.append(part)
        if steps:
            moved, turned, scale = steps[-1]
            direction = direction / (scale * (turned * turned).sum())
        for (moved, turned, scale), part in zip(steps, reversed(parts)):
            direction = direction + (part - scale * (turned * direction).sum()) * moved
        gain = (slope * direction).sum()
        length = 1.0 if steps else 1.0 / max(np.abs(slope).sum(), 1e-12)
        for _ in range(TRIES):
            after, bent = value(at + length * direction)
            if after <= now + 1e-4 * length * gain:
                break
            length /= 2
        else:  # no descent along the direction: rounding has been reached
            break
        moved, turned = length * direction, bent - slope
        if (moved * turned).sum() > 1e-12 * (turned * turned).sum():
            steps.append((moved, turned, 1.0 / (moved * turned).sum()))
        at, now, slope = at + moved, after, bent
    return at, float(np.abs(slope).max())


def fit(vectors: DataFrame, n_terms: int, n_classes: int, total: float, start: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, float]:
    """Coefficients of weighted rows ``(idx, x, y, weight)``, whose last entry is the constant 1; minimises the mean loss with a penalty of strength 1/n.

    A pass broadcasts the coefficients; tasks add up loss and gradient of their rows, and nothing else moves.
    """
    sc = vectors.sparkSession.sparkContext

    def value(flat: np.ndarray) -> tuple[float, np.ndarray]:
        coefficients = flat.reshape(n_terms + 1, n_classes)
        shared = sc.broadcast(coefficients)

        def add(rows: lowrank.SparseRows, sums: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
            scores = rows.times(shared.value)
            scores -= scores.max(axis=1, keepdims=True)
            logs = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
            own = np.arange(len(y))
            error = np.exp(logs)
            error[own, y] -= 1
            rows.add_transposed(error * weight[:, None], sums[:n_terms + 1])
            sums[n_terms + 1, 0] -= (logs[own, y] * weight).sum()

        sums = lowrank.sum_by_term(vectors, n_terms + 2, n_classes, add, ("y", "weight"))
        shared.destroy()
        penalised = coefficients.copy()
        penalised[-1] = 0.0
        slope = (sums[:-1] + penalised) / total
        return float((sums[-1, 0] + (penalised ** 2).sum() / 2) / total), slope.ravel()

    found, gradient = minimise(value, start.ravel(), max_iter, tol)
    if gradient > tol:
        warnings.warn(f"the router's gradient is still {gradient:.1e}", stacklevel=2)
    return found.reshape(n_terms + 1, n_classes), gradient


def case(names: dict, key: Column) -> Column:
    """The entry of a small table: a class has one."""
    return F.element_at(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(F.lit, names.values()))), key)


def train_router(docs: DataFrame, target: str = "product", key: str = "complaint_id", spec: TfidfSpec = ROUTER, min_class: int = 50,
                 max_iter: int = 1000, tol: float = 1e-4, seed: int = 42, start: Router | None = None) -> Router:
    """Train on three quarters of every class with at least ``min_class`` documents and report on the rest.

    A class needs a few documents on both sides of the split; fewer than two such classes are an error. ``start``: an earlier model to go on from, such as that of
    the night before; the result does not depend on it, the number of passes does.
    """
    # Texts are read once, to count their terms. Classes and thresholds come from the key and label columns of the counts, and a document's counts lie in one row
    # with both, so nothing else of it is written or moved.
    rows = docs.filter(F.col(target).isNotNull()).withColumn("label", F.col(target).cast("string"))
    with tfidf.counted_documents(rows, key, "clean_narrative", spec, ["label"]) as counts:
        eligible = classification.eligible_classes(counts, "label", min_class)
        split = classification.stratified_split(eligible, "label", key, 0.25, seed)
        sides = materialize(split.select("label", "is_test"), "router_split")
        sizes = {(r["label"], r["is_test"]): r["n"] for r in sides.groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n")).collect()}
        classes, total = sorted({label for label, _ in sizes}), sum(sizes.values())
        if len(classes) < 2:
            raise ValueError(f"a router needs two classes of {min_class} documents, {target} has {len(classes)}")
        train, test = (split.filter(side).select(key, "label", "terms", "tf") for side in (~F.col("is_test"), F.col("is_test")))
        vocab = tfidf.numbered_vocabulary(train, spec, "router_terms")
        table = vocab.orderBy("idx").select("term", "idf").toArrow()
        terms, n_terms = table["term"].to_pylist(), table.num_rows
        n_train = {c: sizes.get((c, False), 0) for c in classes}
        train_total = sum(n_train.values())
        weight = {c: train_total / (len(classes) * n) for c, n in n_train.items() if n}
        found = tfidf.doc_vectors(train, vocab, key, spec, ["label"])
        # Every row ends with the constant, also one without known terms.
        vectors = materialize(found.select(
            case({c: i for i, c in enumerate(classes)}, F.col("label")).alias("y"), case(weight, F.col("label")).alias("weight"),
            F.concat(F.coalesce("idx", F.array().cast("array<int>")), F.array(F.lit(n_terms))).alias("idx"),
            F.concat(F.coalesce("x", F.array().cast("array<double>")), F.array(F.lit(1.0))).alias("x")), "router_features")
        first = carried_over(start, terms, classes) if start else np.zeros((n_terms + 1, len(classes)))
        coefficients, gradient = fit(vectors, n_terms, len(classes), float(train_total), first, max_iter, tol)
        discard(vectors)
        router = Router(terms, table["idf"].to_numpy(), coefficients, classes, spec, gradient <= tol, gradient)
        predicted = materialize(router.predict_counted(test).select(key, "label", "prediction"), "router_predictions")
    train, test = sides.filter(~F.col("is_test")), sides.filter("is_test")
    baseline = classification.summary_report(classification.majority_baseline(train.select("label"), test.select("label")))
    report = classification.summary_report(predicted).select(
        F.lit("trained").alias("status"), F.lit(target).alias("target"), F.lit(total).cast("bigint").alias("records"),
        F.lit(len(classes)).cast("bigint").alias("classes"), baseline.select("macro_f1").scalar().alias("baseline_macro_f1"),
        F.col("macro_f1").alias("model_macro_f1"), "accuracy", F.lit(router.converged).alias("converged"),
    )
    return replace(router, report=report, class_report=classification.class_report(predicted))
