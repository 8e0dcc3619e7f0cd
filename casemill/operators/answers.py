"""Answer context and deterministic answer for a table of questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.fixed import (
    ABSTAIN_TEXT, ANSWER_MODE, ANSWER_TEXT, GROWTH_TEXT, NO_GROWTH_TEXT, NO_ISSUES_TEXT,
)
from casemill.functions.columns import is_yes, month, or_missing, ratio
from casemill.functions.filters import EQUALITY_FIELDS
from casemill.operators.hybrid import BATCH, QUESTION_FIELDS, without_filters
from casemill.operators.search import citation
from casemill.session import materialize

EXCERPT = 700


def passes(q: Column) -> Column:
    """Whether the current row of :func:`day_counts` passes the filters of question ``q``."""
    equal = [q[c].isNull() | (q[c] == "") | F.coalesce(F.lower(c) == F.lower(q[c]), F.lit(False)) for c in EQUALITY_FIELDS]
    moment = F.col("moment")
    start, end = (q[c].try_cast("timestamp_ntz") for c in ("date_start", "date_end"))
    bounds = [start.isNull() | F.coalesce(moment >= start, F.lit(False)), end.isNull() | F.coalesce(moment <= end, F.lit(False))]
    return reduce(lambda a, b: a & b, equal + bounds)


def day_counts(complaints: DataFrame, questions: DataFrame) -> DataFrame:
    """Complaints by filter columns, response, timeliness and day, counted once for all questions; written.

    A row's ``moment`` stands for all its complaints: no bound of a question lies between them. Midnight, which bounds that are dates ask for, is told apart from
    the rest of the day (its last microsecond); only on days on which a bound has a time of day the full timestamps stay.
    """
    received, day = F.col("date_received"), F.date_trunc("day", F.col("date_received").cast("timestamp_ntz"))
    bounds = questions.select(F.explode(F.array(*(F.col(c).try_cast("timestamp_ntz") for c in ("date_start", "date_end")))).alias("bound"))
    split = bounds.where(F.col("bound") != F.date_trunc("day", "bound")).select(F.collect_set(F.date_trunc("day", "bound"))).scalar()
    moment = F.when(F.array_contains(F.coalesce(split, F.array().cast("array<timestamp_ntz>")), day), received) \
        .otherwise(F.when(received == day, received).otherwise(day + F.expr("interval 1 day") - F.expr("interval 1 microsecond")))
    return materialize(complaints.groupBy(
        *EQUALITY_FIELDS, moment.cast("timestamp_ntz").alias("moment"), or_missing(F.col("company_response_to_consumer")).alias("response"),
        is_yes(F.col("timely_response")).alias("timely"),
    ).agg(F.count(F.lit(1)).alias("n")), "day_counts")


def question_cube(complaints: DataFrame, questions: DataFrame) -> DataFrame:
    """Counts by (question, month, issue, response, timely) over the rows each question's filters leave.

    The questions of a batch travel as one array, every row of the day counts keeps those it passes, and the result is summed while combining. Larger
    question sets go batch by batch over the same counts.
    """
    questions = without_filters(questions)
    counts = day_counts(complaints, questions)
    parts = max(1, -(-questions.count() // BATCH))
    cubes = []
    for part in range(parts):
        batch = questions.filter(F.pmod(F.xxhash64("question_id"), F.lit(parts)) == part)
        asked = batch.select(F.collect_list(F.struct("question_id", *QUESTION_FIELDS))).scalar()
        matched = counts.withColumn("asked", asked).withColumn("question_id", F.explode(F.transform(F.filter("asked", passes), lambda q: q["question_id"])))
        cubes.append(matched.groupBy("question_id", month(F.col("moment")).alias("month"), or_missing(F.col("issue")).alias("issue"), "response", "timely").agg(
            F.sum("n").alias("n"), F.min("moment").alias("first"), F.max("moment").alias("last")))
    return materialize(reduce(DataFrame.unionByName, cubes), "question_cube")


def ranked_values(cube: DataFrame, column: str, n: int) -> DataFrame:
    """``(question_id, <column>_top)``: the n most frequent values as an array of (value, complaints)."""
    counts = cube.groupBy("question_id", column).agg(F.sum("n").alias("complaints"))
    rank = F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("complaints"), column))
    kept = counts.withColumn("rank", rank).filter(F.col("rank") <= n)
    entries = F.array_sort(F.collect_list(F.struct("rank", F.col(column).alias("value"), "complaints")))
    return kept.groupBy("question_id").agg(F.transform(entries, lambda e: F.struct(e["value"].alias("value"), e["complaints"].alias("complaints"))).alias(f"{column}_top"))


def question_analytics(complaints: DataFrame, questions: DataFrame, months: int = 6, n: int = 5) -> DataFrame:
    """Volume, growth, top issues and response metrics of every question that has complaints."""
    cube = question_cube(complaints, questions)
    totals = cube.groupBy("question_id").agg(
        F.sum("n").alias("complaints"), F.to_date(F.min("first")).alias("date_min"), F.to_date(F.max("last")).alias("date_max"),
        ratio(F.sum(F.when(F.col("timely"), F.col("n")).otherwise(0)), F.sum("n")).alias("timely_response_rate"),
    )
    monthly = cube.filter(F.col("month").isNotNull()).groupBy("question_id", "month").agg(F.sum("n").alias("n"))
    age = F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("month")))
    recent, prior = (F.sum(F.when(F.col("age").between(low, low + months - 1), F.col("n"))) for low in (1, months + 1))
    growth = monthly.withColumn("age", age).groupBy("question_id").agg(
        F.when(F.count(F.lit(1)) >= 2 * months, ratio(recent - prior, prior)).alias("growth_rate"))
    joined = totals.join(growth, "question_id", "left")
    for column in ("issue", "response"):
        joined = joined.join(ranked_values(cube, column, n), "question_id", "left")
    return joined


def answer_questions(questions: DataFrame, complaints: DataFrame, evidence: DataFrame, docs: DataFrame, months: int = 6) -> DataFrame:
    """One row per question: metrics, evidence list, citations, deterministic answer and mode.

    ``evidence`` holds the ranked documents of each question (a few per question), ``docs`` their text and metadata. A written ``evidence`` has a known size, so that Spark
    broadcasts it; else the excerpts of all ``docs`` are shuffled to meet it.
    """
    rows = evidence.join(docs.select("complaint_id", "company", "product", "issue", F.substring("clean_narrative", 1, EXCERPT).alias("excerpt")), "complaint_id")
    record = F.struct("rank", citation(F.col("complaint_id")).alias("citation"), "complaint_id", "company", "product", "issue", "hybrid_score", "excerpt")
    grouped = rows.groupBy("question_id").agg(F.array_sort(F.collect_list(record)).alias("evidence"))
    joined = questions.select("question_id", "question").join(question_analytics(complaints, questions, months), "question_id", "left") \
        .join(grouped, "question_id", "left")
    count = F.format_number(F.coalesce("complaints", F.lit(0)), 0)
    issues = F.array_join(F.transform(F.slice("issue_top", 1, 3), lambda e: F.concat(e["value"], F.lit(" ("), F.format_number(e["complaints"], 0), F.lit(")"))), ", ")
    changed = F.format_string(GROWTH_TEXT, F.lit(months), F.format_string("%.1f%%", F.bround(F.col("growth_rate") * 100, 1)))
    growth = F.when(F.col("growth_rate").isNotNull(), changed).otherwise(NO_GROWTH_TEXT)
    cited = F.transform("evidence", lambda e: e["citation"])
    answer = F.when(F.col("evidence").isNull(), F.format_string(ABSTAIN_TEXT, count)).otherwise(F.format_string(
        ANSWER_TEXT, count, F.coalesce(F.nullif(issues, F.lit("")), F.lit(NO_ISSUES_TEXT)), F.array_join(F.slice(cited, 1, 3), " "), growth))
    return joined.withColumns({
        "answer": answer, "citations": F.coalesce(F.slice(cited, 1, 8), F.array().cast("array<string>")), "mode": F.lit(ANSWER_MODE),
    })
