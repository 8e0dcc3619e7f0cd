"""Classification metrics from predictions, the majority baseline and the stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casemill.functions.columns import ratio
from casemill.session import materialize


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predictions.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def class_report(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class that occurs as label or prediction; empty ratios are 0."""
    cells = confusion(predictions, label, prediction)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.lit(True).alias("is_label"), F.lit(False).alias("is_prediction")),
        F.struct(F.col("prediction").alias("class"), F.lit(False).alias("is_label"), F.lit(True).alias("is_prediction")),
    )
    rows = cells.withColumn("hit", F.col("label") == F.col("prediction")).select("n", "hit", F.inline(sides))
    per_class = rows.groupBy("class").agg(
        F.sum(F.when(F.col("is_label") & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("is_label"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("is_prediction"), F.col("n")).otherwise(0)).alias("predicted"),
    )
    zero = F.lit(0.0)
    return per_class.select(
        "class", F.coalesce(ratio(F.col("tp"), F.col("predicted")), zero).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("support")), zero).alias("recall"),
        F.coalesce(ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")), zero).alias("f1"), "support", "tp",
    )


def summary_report(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, macro and support-weighted precision, recall and F1, records and classes."""
    report = class_report(predictions, label, prediction)
    total = F.sum("support")
    return report.agg(
        total.alias("records"), F.count(F.lit(1)).alias("classes"), ratio(F.sum("tp"), total).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
    )


def eligible_classes(df: DataFrame, label: str, min_class: int = 50) -> DataFrame:
    """Rows whose class has at least ``min_class`` rows."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return df.join(F.broadcast(counts.filter(F.col("n") >= min_class).select(label)), label, "left_semi")  # a row per class; the rows stay where they are


def majority_class(train: DataFrame, label: str = "label") -> DataFrame:
    """One row: the most frequent training class, ties by name."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), label).limit(1).select(F.col(label).alias("prediction"))


def majority_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Test rows predicted as the most frequent training class."""
    return test.withColumn("prediction", majority_class(train, label).scalar())


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``is_test``: exactly ``round(fraction x class size)`` rows of every class, chosen by hash of the key.

    Rows are ordered by md5 of the key within their class and cut at a threshold. Instead of sorting a class in one
    task, rows are counted per (class, first four hash digits); a running sum finds the bucket that holds the cut, and
    only the rows of that bucket, about 1 in 65,536, are ranked to read the threshold. The data itself then passes
    once, compared with one threshold per class.
    """
    def with_hash(rows: DataFrame) -> DataFrame:
        return rows.withColumn("h", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))))

    hashed = with_hash(df.select(key, label)).withColumn("bucket", F.substring("h", 1, 4))
    buckets = hashed.groupBy(label, "bucket").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy(label).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counted = buckets.withColumns({
        "upto": F.sum("n").over(running),
        "wanted": F.round(F.sum("n").over(Window.partitionBy(label)) * test_fraction).cast("bigint"),
    })
    cut = counted.filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted"))) \
        .select(label, "bucket", (F.col("wanted") - (F.col("upto") - F.col("n"))).alias("from_bucket"))
    place = F.row_number().over(Window.partitionBy(label).orderBy("h", key))
    last = hashed.join(cut, [label, "bucket"]).withColumn("place", place).filter(F.col("place") == F.col("from_bucket")) \
        .select(label, F.col("h").alias("last_h"), F.col(key).alias("last_key"))
    inside = F.struct(F.col("h"), F.col(key)) <= F.struct(F.col("last_h"), F.col("last_key"))
    # Written, as the flagged rows may be read several times, and broadcast, a threshold per class: a join on the class would send all rows of a class to one task.
    flagged = with_hash(df).join(F.broadcast(materialize(last, "thresholds")), label, "left").withColumn("is_test", F.col("last_h").isNotNull() & inside)
    return flagged.select(*df.columns, "is_test")
