"""Scenario value model on a table of workloads."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casemill.fixed import ASSUMPTION_DEFAULTS, SCENARIOS, SENSITIVITY_FIELDS
from casemill.functions.columns import ratio, share
from casemill.operators.quantiles import exact_quantiles

ASSUMPTIONS = ["observed_complaints", "hourly_wage", *ASSUMPTION_DEFAULTS]


def with_assumptions(workloads: DataFrame) -> DataFrame:
    """Fill in the default of every assumption the table does not carry."""
    missing = {c: F.lit(v) for c, v in ASSUMPTION_DEFAULTS.items() if c not in workloads.columns}
    return workloads.withColumns(missing) if missing else workloads


def net_value(c: Mapping[str, Column]) -> Column:
    """Three-year net value as one expression over the given assumptions."""
    hours = c["observed_complaints"] * c["average_handling_minutes"] / 60
    released = hours * c["ai_addressable_share"] * c["time_reduction"] * c["adoption_rate"] * c["success_probability"]
    return (released * c["hourly_wage"] - c["annual_operating_cost"]) * 3 - c["implementation_cost"]


def calculate_value(workloads: DataFrame) -> DataFrame:
    """Hours, capacity value, net value, ROI, NPV and payback per row; ROI is null on zero cost."""
    c = F.col
    flow = c("annual_net_value")
    growth = F.lit(1.0) + c("discount_rate")
    total_cost = c("implementation_cost") + c("annual_operating_cost") * 3
    discounted = reduce(lambda a, b: a + b, [flow / F.pow(growth, F.lit(float(year))) for year in (1, 2, 3)])
    outputs = {
        "observed_hours_workload": c("observed_complaints") * c("average_handling_minutes") / 60,
        "ai_addressable_complaints": c("observed_complaints") * c("ai_addressable_share"),
        "gross_hours_released": c("observed_hours_workload") * c("ai_addressable_share") * c("time_reduction"),
        "expected_hours_released": c("gross_hours_released") * c("adoption_rate") * c("success_probability"),
        "estimated_annual_capacity_value": c("expected_hours_released") * c("hourly_wage"),
        "annual_net_value": c("estimated_annual_capacity_value") - c("annual_operating_cost"),
        "three_year_net_value": net_value({a: c(a) for a in ASSUMPTIONS}),
        "roi": ratio(c("estimated_annual_capacity_value") * 3 - total_cost, total_cost),
        "npv": discounted - c("implementation_cost"),
        "payback_years": F.when(flow <= 0, F.lit(float("inf"))).otherwise(F.try_divide(c("implementation_cost"), flow)),
    }
    rows = with_assumptions(workloads)
    for name, expression in outputs.items():
        rows = rows.withColumn(name, expression)
    return rows


def apply_scenarios(workloads: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row per workload and scenario; the scenarios are a literal array, so nothing is joined or shuffled."""
    fields = list(next(iter(SCENARIOS.values())))
    literal = F.array(*[
        F.struct(F.lit(name).alias("scenario"), *[F.lit(float(SCENARIOS[name][f])).alias(f"s_{f}") for f in fields])
        for name in (names or SCENARIOS)
    ])
    rows = with_assumptions(workloads)
    rows = rows.select("*", F.inline(literal))
    changed = {f: F.col(f) * F.col(f"s_{f}") if f == "implementation_cost" else F.col(f"s_{f}") for f in fields}
    return rows.withColumns(changed).drop(*[f"s_{f}" for f in fields])


def scenario_table(workloads: DataFrame) -> DataFrame:
    return calculate_value(apply_scenarios(workloads))


def sensitivity(workloads: DataFrame, swing: float = 0.2) -> DataFrame:
    """Per workload and assumption: change of the three-year net value when it moves by ``swing`` either way, and its rank, widest range first.

    Ranges that differ by less than a ten-thousandth are ties, which keep the order of the assumptions.

    Each workload row unrolls into one row per assumption inside its task; nothing is shuffled.
    """
    base = with_assumptions(workloads)
    now = {a: F.col(a) for a in ASSUMPTIONS}

    def moved(field: str, factor: float) -> Column:
        return net_value({**now, field: F.greatest(now[field] * factor, F.lit(0.0))})

    cases = F.array(*[
        F.struct((-F.round(F.abs(moved(f, 1 + swing) - moved(f, 1 - swing)), 4)).alias("order"), F.lit(i).alias("place"), F.lit(f).alias("assumption"),
                 moved(f, 1 - swing).alias("low"), moved(f, 1 + swing).alias("high"))
        for i, f in enumerate(SENSITIVITY_FIELDS)
    ])
    rows = base.select(*base.columns, net_value(now).alias("base"), F.posexplode(F.array_sort(cases)).alias("at", "case"))
    rows = rows.select(*base.columns, "base", (F.col("at") + 1).alias("rank"), "case.assumption", "case.low", "case.high")
    return rows.withColumns({
        "low_case_delta": F.col("low") - F.col("base"), "high_case_delta": F.col("high") - F.col("base"),
        "range": F.abs(F.col("high") - F.col("low")),
    }).drop("low", "high", "base")


def sample_summary(samples: DataFrame) -> DataFrame:
    """One row: quantiles of ``npv`` (linear interpolation) and success shares over a table of samples."""
    names = {0.1: "p10_npv", 0.5: "p50_npv", 0.9: "p90_npv"}
    quantiles = exact_quantiles(samples, "npv", list(names)).agg(F.struct(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name) for p, name in names.items()
    ])).scalar()
    return samples.agg(
        F.count(F.lit(1)).alias("simulations"), share(F.col("npv") > 0).alias("probability_npv_positive"),
        share(F.col("payback_years") <= 3).alias("probability_payback_within_3_years"),
    ).withColumn("q", quantiles).select(
        "simulations", F.col("q.p50_npv").alias("median_npv"), "q.*", "probability_npv_positive",
        "probability_payback_within_3_years",
    )
