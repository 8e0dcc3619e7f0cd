"""Small fixtures: nulls, ties, gaps, hot keys, and results checked against brute force."""

import csv
import datetime as dt
import math
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casemill.functions.columns import SPACES, WIDE_SPACES, clean_number, strip, to_long, to_timestamp
from casemill.functions.filters import CaseFilters, apply_filters
from casemill.functions.text import clean_text, narratives, normalize_company_name
from casemill.operators import (
    anomaly, answers, benchmark, classification, entities, evaluation, hybrid, lowrank, macro_context, metrics, opportunities, quality, quantiles,
    router, scale, search, tfidf, topics, value,
)
from casemill.sources import artifacts, complaints, entity_seed, facts, macro, questions, records, wages


def column(df, name):
    return [r[name] for r in df.collect()]


def monthly_cases(spark, counts, issue="Late fee"):
    """One row per complaint; counts[i] complaints in month i from 2024-01."""
    rows = []
    for i, n in enumerate(counts):
        day = dt.datetime(2024 + i // 12, i % 12 + 1, 1)
        rows += [(len(rows) + j, day, "Credit card", issue, "Mapped Bank", "NY", "Web", "Closed", "Yes", None) for j in range(n)]
    return spark.createDataFrame(rows, "complaint_id long, date_received timestamp_ntz, product string, issue string, company string, state string, "
                                       "submitted_via string, company_response_to_consumer string, timely_response string, "
                                       "consumer_complaint_narrative string")


# --- coercion and ingest ------------------------------------------------------------------------------
def test_coercion(spark):
    row = spark.range(1).select(
        to_long(F.lit(" 12 ")).alias("a"), to_long(F.lit("abc")).alias("b"), to_long(F.lit("12.0")).alias("c"), to_long(F.lit("1.5")).alias("d"),
        to_timestamp(F.lit("2024-02-30")).alias("e"), to_timestamp(F.lit("01/31/2024")).alias("f"), strip(F.lit("\t a b 　")).alias("g"),
        clean_number(F.lit("48,880")).alias("h"), clean_number(F.lit("*")).alias("i"), clean_number(F.lit("#")).alias("j"),
    ).first()
    assert list(row) == [12, None, 12, None, None, dt.datetime(2024, 1, 31), "a b", 48880.0, None, None]


@pytest.mark.parametrize("split, batch", [("64m", 10_000), ("300b", 10_000), ("97b", 3), ("2k", 2)])
def test_records_over_splits(spark, tmp_path, split, batch):
    """Line breaks, quotes and separators inside quotes, whatever the splits and batches; two files with different line ends."""
    draw = np.random.default_rng(5)
    want = []
    for name, ending in (("a", "\n"), ("b", "\r\n")):
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator=ending)
            writer.writerow(["a", "b c", "d"])
            for i in range(40):
                row = [f"{name}{i}", "".join(draw.choice(list('xy",\n é'), draw.integers(60))), str(draw.choice(["", "z", '"', "q\n\n\nr" * 12]))]
                writer.writerow(row)
                want.append(tuple(x or None for x in row))
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1b", "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = records.read_csv(spark, str(tmp_path))
        assert found.columns == ["a", "b c", "d"]
        assert sorted((tuple(x or None for x in r) for r in found.collect()), key=repr) == sorted(want, key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_records_are_put_together_once(spark, tmp_path):
    """Without a record in two splits the lines pass one Python step; text ends are trimmed without patterns, with the same result."""
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\r\n\n2,z\r\r\n', newline="")
    rows = records.read_csv(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert [tuple(r) for r in rows.collect()] == [("1", "x\ny"), ("2", "z")]
    spaces = SPACES + WIDE_SPACES
    texts = [f"{a}{t}{b}" for t in ("", "a", f"a{spaces}é", "\u200b") for a in ("", *spaces, "\n\r", spaces) for b in ("", *spaces, "\r\n", spaces)]
    trimmed = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s"))
    assert "regexp" not in trimmed._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.s == r.t.strip(spaces) for r in trimmed.collect())


def test_term_counts_keep_columns(spark):
    docs = spark.createDataFrame([(1, "a", "late fee fee"), (1, None, "late"), (None, "c", None)], "complaint_id long, product string, text string")
    spec = tfidf.TfidfSpec(None, stop_words=())
    rows = tfidf.count_terms(docs, "complaint_id", "text", spec, ["product"]).collect()
    found = {(r.complaint_id, r.product): dict(zip(r.terms.split("\n"), np.frombuffer(r.tf, np.int32))) if r.terms else {} for r in rows}
    assert found == {(1, "a"): {"late": 1, "fee": 2, "late fee": 1, "fee fee": 1}, (1, None): {"late": 1}, (None, "c"): {}}


def test_normalize_partial_columns(spark):
    raw = spark.createDataFrame([("2024-01-05", "\tMortgage ", "abc")], "`Date received` string, Product string, `Complaint ID` string")
    out = complaints.normalize_columns(raw)
    assert out.schema.fieldNames() == complaints.COMPLAINT_SCHEMA.fieldNames()
    row = out.first()
    assert (row.date_received, row.product, row.complaint_id, row.company) == (dt.datetime(2024, 1, 5), "Mortgage", None, None)


def test_refresh_moves_and_drops_month(spark, tmp_path):
    def rows(*items):
        return complaints.normalize_columns(spark.createDataFrame(list(items), "complaint_id long, date_received string, issue string"))

    store = str(tmp_path / "store")
    complaints.write_store(rows((1, "2024-01-05", "a"), (2, "2024-02-05", "a"), (3, "2024-03-05", "a")), store)
    complaints.refresh_store(spark, store, rows((1, "2024-02-07", "b"), (4, "2024-04-01", "b"), (4, "2024-04-02", "c"), (None, "2024-04-03", "d")))
    found = {(r.complaint_id, r.issue, r.received_month) for r in complaints.read_store(spark, store).collect()}
    assert found == {(1, "b", "2024-02"), (2, "a", "2024-02"), (3, "a", "2024-03"), (4, "c", "2024-04"), (None, "d", "2024-04")}
    assert "2024-01" not in complaints.current(spark, store)
    before = found
    complaints.refresh_store(spark, store, rows((4, "2024-04-02", "c")))
    assert {(r.complaint_id, r.issue, r.received_month) for r in complaints.read_store(spark, store).collect()} == before
    for _ in range(3):  # a replayed window without ids changes nothing
        complaints.refresh_store(spark, store, rows((None, "2024-04-03", "d"), (None, "2024-04-03", "d")))
    assert sorted(r.issue for r in complaints.read_store(spark, store).collect()) == ["a", "a", "b", "c", "d"]
    assert [p.name for p in tmp_path.iterdir()] == ["store"]


def test_readers_see_one_state(spark, tmp_path, monkeypatch):
    def rows(*items):
        return complaints.normalize_columns(spark.createDataFrame(list(items), "complaint_id long, date_received string, issue string"))

    def state(df):
        return sorted((r.complaint_id, r.issue, r.received_month) for r in df.collect())

    store = str(tmp_path / "store")
    complaints.write_store(rows((1, "2024-01-05", "a"), (2, "2024-02-05", "a")), store)
    reader = complaints.read_store(spark, store)
    first = state(reader)
    window = rows((1, "2024-02-07", "b"), (2, "2024-01-01", "b"))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:  # all months are written, but nothing is put in place
        broken.setattr(complaints, "commit", fail)
        with pytest.raises(OSError):
            complaints.refresh_store(spark, store, window)
    assert state(complaints.read_store(spark, store)) == first
    complaints.refresh_store(spark, store, window)
    assert state(reader) == first  # a reader that began before the commit reads on
    assert state(complaints.read_store(spark, store)) == [(1, "b", "2024-02"), (2, "b", "2024-01")]
    for k in range(3):
        complaints.refresh_store(spark, store, rows((9, "2024-03-01", f"c{k}")))
    versions = {p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("version=")}
    assert len(versions) <= 4 and len(complaints.commits(spark, store)) <= 2


def test_empty_or_invalid_ingest_keeps_the_store(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = complaints.normalize_columns(spark.createDataFrame([(1, "2024-01-05")], "complaint_id long, date_received string"))

    def refuse(_):
        raise ValueError("invalid")

    complaints.write_store(rows, store)
    with pytest.raises(ValueError, match="no complaint rows"):
        complaints.write_store(rows.limit(0), store)
    with pytest.raises(ValueError, match="invalid"):
        complaints.write_store(rows.union(rows), store, check=refuse)
    assert complaints.read_store(spark, store).count() == 1
    complaints.write_store(rows.union(rows), store)
    assert complaints.read_store(spark, store).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["store"]


def test_absent_artifact_is_empty(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string").schema
    assert artifacts.read_csv_table(spark, str(tmp_path / "none"), schema).count() == 0


def test_question_file(spark, tmp_path):
    path = tmp_path / "q.json"
    path.write_text('[{"question_id":"Q1","question":"x","filters":{"product":"A","unknown":"z"}},'
                    '{"question_id":"Q2","question":"y","expected_behavior":"abstain","expected_terms":["t"]}]')
    first, second = questions.read_questions(spark, str(path)).orderBy("question_id").collect()
    assert (first.filters.product, first.expected_behavior, first.expected_terms) == ("A", "retrieve", [])
    assert (second.expected_behavior, second.expected_terms) == ("abstain", ["t"])


# --- metrics ------------------------------------------------------------------------------------------
def test_validation(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2999, 1, 1)), (None, None), (None, None)],
                               "complaint_id long, date_received timestamp_ntz")
    assert {r.check for r in quality.validate_schema(df).filter("violated").collect()} == {
        "missing_columns", "duplicate_ids", "unparseable_dates", "future_dates"}
    one_null = df.filter("complaint_id is null").limit(1).select("complaint_id")
    assert "duplicate_ids" not in {r.check for r in quality.validate_schema(one_null).filter("violated").collect()}


def test_profile(spark):
    row = quality.column_profile(spark.createDataFrame([(1.0,), (None,), (3.0,)], "a double")).first()
    assert (row.records, row.missing_count, row.missing_rate, row.unique_values) == (3, 1, 0.3333, 2)


def test_spikes(spark):
    steady = anomaly.detect_spikes(monthly_cases(spark, [20] * 14 + [80])).orderBy("month").collect()
    assert len(steady) == 15 and steady[-1].z_score is None and not steady[-1].spike_flag
    assert steady[5].baseline_mean is None and steady[6].baseline_mean == 20
    varied = anomaly.detect_spikes(monthly_cases(spark, [18, 22] * 7 + [80])).orderBy("month").collect()
    assert varied[-1].z_score == pytest.approx((80 - 20) / 2) and varied[-1].spike_flag
    score = anomaly.emerging_scores(monthly_cases(spark, [18, 22] * 7 + [80])).first()
    assert score.emerging_issue_score == pytest.approx(0.65 * 30 + 0.35)


def test_growth_needs_history(spark):
    row = metrics.growth_rate(monthly_cases(spark, [3] * 11)).first()
    assert row.status == "insufficient_history" and row.growth_rate is None
    row = metrics.growth_rate(monthly_cases(spark, [2] * 6 + [3] * 6)).first()
    assert (row.recent_complaints, row.prior_complaints, row.growth_rate) == (18, 12, 0.5)


def test_unknown_column(spark):
    assert metrics.top_categories(monthly_cases(spark, [1]), "nothing").count() == 0


def test_end_day_means_midnight(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2)), (2, dt.datetime(2024, 1, 2, 9)), (3, None)], "id int, date_received timestamp_ntz")
    assert column(apply_filters(df, CaseFilters(date_end="2024-01-02")), "id") == [1]
    assert apply_filters(df, CaseFilters(product="")).count() == 3


def test_date_bound_is_pushed_to_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumnRenamed("o_orderdate", "date_received")
    plan = apply_filters(df, CaseFilters(date_start="1996-01-01"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_benchmark(spark):
    rows = monthly_cases(spark, [20] * 14 + [80])
    sizes = spark.createDataFrame([("Mapped Bank", 100e9, 10e9), (None, 1.0, 1.0)], "cfpb_company_name string, assets double, revenue double")
    row = benchmark.company_benchmark(rows, sizes).first()
    assert (row.complaints_per_1b_assets, row.complaints_per_1b_revenue) == (pytest.approx(3.6), pytest.approx(36.0))
    zero = sizes.withColumn("assets", F.lit(0.0))
    assert benchmark.company_benchmark(rows, zero).first().complaints_per_1b_assets is None


def test_quantiles_match_brute_force(spark):
    rng = np.random.default_rng(1)
    for values in (rng.normal(size=5000), np.repeat([1.0, 5.0], [3000, 1500]), np.array([4.0]), np.array([1.0, 2.0])):
        df = spark.createDataFrame([(float(v),) for v in values], "v double")
        found = {r.probability: r.quantile for r in quantiles.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
        assert found == pytest.approx({p: np.quantile(values, p) for p in found})


# --- enrichment ---------------------------------------------------------------------------------------
def test_facts_priority_and_fallback(spark):
    def fact(**kw):
        base = dict(fy=2023, fp="FY", form="10-K", end="2023-12-31", filed="2024-02-01", val=1.0, accn="a")
        return {**base, **kw}

    import json
    both = {"cik": "1", "entityName": "A", "facts": {"us-gaap": {
        "Revenues": {"units": {"USD": [fact(val=10.0), fact(val=None)], "EUR": [fact(val=99.0)]}},
        "InterestAndDividendIncomeOperating": {"units": {"USD": [fact(val=30.0), fact(val=31.0, filed="2024-03-01"), fact(fp="Q1", val=5.0)]}},
        "Goodwill": {"units": {"USD": [fact(val=7.0)]}}}}}
    no_year = {"cik": 2, "entityName": "B", "facts": {"us-gaap": {"Assets": {"units": {"USD": [fact(fp="Q4", val=3.0), fact(fp="Q4", form="10-Q", val=4.0)]}}}}}
    docs = facts.parse_company_facts(spark.createDataFrame([(json.dumps(both),), (json.dumps(no_year),), ("{broken",)], "value string"), "value")
    assert facts.fact_errors(docs).count() == 1
    rows = facts.fact_rows(docs)
    assert {(r.sec_cik, r.metric_name, r.value) for r in scale.resolve_facts(rows).collect()} == {
        ("0000000001", "revenue", 31.0), ("0000000002", "assets", 3.0)}
    assert 10.0 in column(scale.resolve_facts(rows, prefer="first"), "value")
    mapped = spark.createDataFrame([("A", "0000000001", "HIGH CONFIDENCE", False), ("B", "0000000002", "HIGH CONFIDENCE", None)],
                                   "cfpb_company_name string, sec_cik string, confidence_tier string, manual_review_required boolean")
    allowed = {r.cfpb_company_name: r.normalization_allowed for r in scale.scale_table(scale.resolve_facts(rows), mapped).collect()}
    assert allowed == {"A": True, "B": False}


def test_constant_series_has_no_correlation(spark):
    rows = monthly_cases(spark, [i % 5 + 1 for i in range(18)])
    months = [f"{2024 + i // 12}-{i % 12 + 1:02d}-01" for i in range(18)]
    obs = [("UNRATE", m, 1.0) for m in months] + [("X", m, float(i % 5)) for i, m in enumerate(months)] + [("SHORT", m, 2.0) for m in months[:11]]
    found = {(r.series_id, r.lag_months): r for r in macro_context.lagged_correlation(
        rows, spark.createDataFrame(obs, "series_id string, date string, value double")).collect()}
    assert set(k for k, _ in found) == {"UNRATE", "X"}
    assert found["UNRATE", 0].correlation is None and found["X", 0].correlation == pytest.approx(1.0)
    assert found["X", 6].paired_months == 12 and found["UNRATE", 0].description.startswith("Civilian")


def test_observation_marks_are_dropped(spark):
    payload = spark.createDataFrame([("UNRATE", [("2024-01-01", "3.5"), ("2024-02-01", ".")])], macro.OBSERVATIONS_SCHEMA)
    assert column(macro.observation_rows(payload), "value") == [3.5]


def test_wages(spark):
    raw = spark.createDataFrame([("43-4051", "Reps", "21.50", "48,880"), ("99-9999", "Other", "1", "2"), ("13-1111", "Analysts", "*", "#")],
                                " OCC_CODE string, OCC_TITLE string, H_MEAN string, A_MEAN string".strip())
    rows = wages.normalize_wages(raw).collect()
    assert [(r.occupation_code, r.mean_hourly_wage, r.mean_annual_wage) for r in rows] == [("13-1111", None, None), ("43-4051", 21.5, 48880.0)]
    assert wages.default_hourly_wage(wages.normalize_wages(raw)).first().hourly_wage == 21.5
    assert wages.default_hourly_wage(wages.normalize_wages(raw).limit(0)).first().hourly_wage == 24.0


# --- entities -----------------------------------------------------------------------------------------
def test_company_names(spark):
    names = ["Bank of America, National Association", "JPMORGAN CHASE & CO.", "CITIBANK, N.A.", "The Bank of", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(normalize_company_name(F.col("n")).alias("n"))
    assert column(df, "n") == ["america", "jpmorgan chase and", "citibank n a", "", ""]


def test_seed_recovery(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("cfpb_company_name,canonical,sec_cik,ticker,m,c,f,notes\nBANK OF X, NATIONAL ASSOCIATION,X Corp,0000070858,BAC,manual_parent,0.95,true,a, b\nbroken,line\n")
    row = entity_seed.coerce_seed_map(entity_seed.read_seed_map(spark, str(path))).first()
    assert (row.cfpb_company_name, row.canonical_company_name, row.confidence_tier, row.manual_review_required, row.notes) == (
        "BANK OF X, NATIONAL ASSOCIATION", "X Corp", "MEDIUM - REVIEW", True, "a, b")


def test_seed_lines_of_neither_form(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(",".join(entity_seed.SEED_COLUMNS) + "\nA,A Inc.,19617,S,manual,0.98,false,n\nbroken,line\n,0000000001,a,b,c,d,e\n")
    assert column(entity_seed.seed_errors(spark.read.text(str(path))), "value") == ["broken,line", ",0000000001,a,b,c,d,e"]


def test_seed_forms(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("\n".join([
        ",".join(entity_seed.SEED_COLUMNS), "Short Cik,Short Inc.,19617,S,manual,0.98,false,n", "No Number,None Inc.,,N,manual,0.9,true,", '"Quoted, ""Q"" N.A.",Q Inc.,0000000007,Q,m,0.9,false,"a, b"',
        "Stray, N.A.,Stray Inc.,0000000008,T,m,0.9,false,see,0000000009,x,y,z,w"]))
    rows = {r.ticker: r for r in entity_seed.read_seed_map(spark, str(path)).collect()}
    assert sorted(rows) == ["N", "Q", "S", "T"]
    assert (rows["S"].sec_cik, rows["N"].sec_cik, rows["N"].notes) == ("19617", None, None)
    assert (rows["Q"].cfpb_company_name, rows["Q"].notes) == ('Quoted, "Q" N.A.', "a, b")
    assert (rows["T"].cfpb_company_name, rows["T"].canonical_company_name, rows["T"].sec_cik, rows["T"].notes) == ("Stray, N.A.", "Stray Inc.", "0000000008", "see,0000000009,x,y,z,w")


def test_annual_facts_without_a_name(spark):
    facts_ = spark.createDataFrame([(None, "1", "FY", "10-K"), (None, "1", "Q2", "10-Q"), ("A", "1", "Q2", "10-K")], "company string, sec_cik string, fiscal_period string, form string")
    assert sorted((r.company or "", r.fiscal_period) for r in scale.prefer_annual(facts_).collect()) == [("", "FY"), ("A", "Q2")]


def test_fuzzy_match_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "north", "south"]
    name = lambda: " ".join(rng.choice(words, size=rng.integers(1, 4)))
    canon = sorted({name() for _ in range(60)})
    seed = spark.createDataFrame([(c.upper(), c, i) for i, c in enumerate(canon)], "cfpb_company_name string, canonical_company_name string, seed_order long")
    asked = sorted({name() + "x" for _ in range(30)})
    found = {r["query"]: (r.canonical_company_name, r.match_score) for r in entities.fuzzy_best(
        spark.createDataFrame([(a,) for a in asked], "normalized string"), seed).collect()}
    for a in asked:
        scores = [SequenceMatcher(None, a, c).ratio() for c in canon]
        assert found[a] == (canon[int(np.argmax(scores))], pytest.approx(max(scores)))


def test_review_prefers_alias(spark):
    seed = entity_seed.coerce_seed_map(spark.createDataFrame(
        [("CITIBANK", "Citigroup Inc.", "831001", "C", "manual_seed", "0.98", "false", "", 0), ("OTHER", "Other Corp", "5", "O", "manual_seed", "0.9", "false", "", 1)],
        "cfpb_company_name string, canonical_company_name string, sec_cik string, ticker string, match_method string, confidence string, "
        "manual_review_flag string, notes string, seed_order long"))
    companies = spark.createDataFrame([("Citizens Trust", 5), ("Othr", 3), ("citibank", 9)], "cfpb_company_name string, complaints long")
    rows = {r.cfpb_company_name: r for r in entities.review_table(companies, seed).collect()}
    assert set(rows) == {"Citizens Trust", "Othr"}
    assert rows["Citizens Trust"].match_method == "fuzzy_suggestion"
    parts = {r.cfpb_company_name: r for r in entities.review_table(companies, seed, whole_words=False).collect()}
    assert parts["Citizens Trust"].match_method == "alias_suggestion" and parts["Citizens Trust"].suggested_sec_cik == "0000831001"
    assert rows["Othr"].suggested_canonical_company_name == "Other Corp" and rows["Othr"].manual_review_required


# --- text and retrieval -------------------------------------------------------------------------------
def test_cleaning(spark):
    texts = ["I paid XXXX on xx/xx/2025 and got no response.", None, " a\r\n\tb   c ", "exx XX"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(clean_text(F.col("t")).alias("t"))
    assert column(df, "t") == ["I paid on / /2025 and got no response.", "", "a b c", "exx"]
    lengths = spark.createDataFrame([("a" * 79,), ("a" * 80,)], "consumer_complaint_narrative string")
    assert narratives(lengths).count() == 1


def small_docs(spark, n=40):
    rng = np.random.default_rng(5)
    words = [f"word{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(words, size=20)), "A" if i % 3 else "B", f"c{i % 4}") for i in range(n)]
    return spark.createDataFrame(rows, "complaint_id long, clean_narrative string, product string, company string").withColumns({
        "issue": F.lit("x"), "state": F.lit("NY"), "date_received": F.lit("2024-01-01").cast("timestamp_ntz")})


def test_search_fills_up_with_zero_scores(spark):
    docs = small_docs(spark, 6)
    asked = spark.createDataFrame([(1, "nothing known"), (2, "word1")], "question_id long, question string")
    rows = search.lexical_search(docs, asked, k=4).collect()
    assert [r.complaint_id for r in sorted((r for r in rows if r.question_id == 1), key=lambda r: r.rank)] == [0, 1, 2, 3]
    assert len(rows) == 8


def dense_rows(vectors, n_terms):
    rows = vectors.orderBy("complaint_id").collect()
    matrix = np.zeros((len(rows), n_terms))
    for i, r in enumerate(rows):
        matrix[i, r.idx] = r.x
    return [r.complaint_id for r in rows], matrix


def test_low_rank_models_match_numpy(spark):
    docs, spec = small_docs(spark), tfidf.TfidfSpec(500, 1)
    counts = tfidf.count_terms(docs, "complaint_id", "clean_narrative", spec)
    vocab = tfidf.numbered(tfidf.vocabulary(counts, spec)).cache()
    n_terms = vocab.count()
    vectors = tfidf.doc_vectors(counts, vocab, "complaint_id", spec).cache()
    _, matrix = dense_rows(vectors, n_terms)
    assert np.allclose(np.linalg.norm(matrix, axis=1), 1)
    _, expected, rows = np.linalg.svd(matrix, full_matrices=False)
    shipped = lowrank.right_singular(vectors, n_terms, 5)
    assert (shipped.values ** 2).sum() >= 0.95 * (expected[:5] ** 2).sum() and np.allclose(shipped.vectors.T @ shipped.vectors, np.eye(5))
    left = matrix - matrix @ shipped.vectors @ shipped.vectors.T
    assert shipped.residual == pytest.approx((left ** 2).sum() / (matrix ** 2).sum())  # the reported error is the true one
    exact = lowrank.right_singular(vectors, n_terms, 5, passes=25)
    assert np.allclose(exact.values, expected[:5], rtol=1e-4) and exact.residual <= shipped.residual + 1e-12
    assert np.allclose(np.abs((rows[:2] * exact.vectors.T[:2]).sum(axis=1)), 1, atol=1e-3)
    components, errors, sums = lowrank.nmf_components(vectors, n_terms, 40, 4, max_iter=6, tol=0)
    assert sums.error(components) == pytest.approx(errors[-1]) and sums.length == pytest.approx((matrix ** 2).sum())
    best = lowrank.fit_weights(matrix @ components.T, components @ components.T)
    assert ((matrix - best @ components) ** 2).sum() <= errors[-1] + 1e-9  # weights of the last components can only be better
    assert (components >= 0).all() and all(b <= a + 1e-9 for a, b in zip(errors, errors[1:]))
    # No factorisation of the rank beats the singular values.
    assert errors[-1] >= (expected[4:] ** 2).sum() - 1e-9


def test_hybrid_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n, width, n_terms = 200, 8, 25
    sparse = [(i, sorted(rng.choice(n_terms, size=4, replace=False).tolist()), rng.random(4).tolist()) for i in range(n)]
    dense = rng.normal(size=(n, width))
    rows = [(i, idx, x, dense[i].tolist() if i % 10 else None, f"P{i % 3}", "c", "i", "s", dt.datetime(2024, 1, 1 + i % 28)) for i, idx, x in sparse]
    schema = ("complaint_id long, idx array<int>, x array<double>, dense array<double>, product string, company string, issue string, state string, "
              "date_received timestamp_ntz")
    vectors = spark.createDataFrame(rows, schema).repartition(5)
    asked_rows = [(q, [1, 5, 9], [0.5, 0.2, 0.9], rng.normal(size=width).tolist(), "p1" if q % 2 else None, "2024-01-10" if q == 3 else None,
                   "nowhere" if q == 4 else None) for q in range(5)]
    asked = hybrid.without_filters(spark.createDataFrame(
        asked_rows, "question_id long, idx array<int>, x array<double>, dense array<double>, product string, date_start string, state string"))
    evidence, trace = hybrid.hybrid_search(vectors, asked, k=6)
    found = {}
    for r in evidence.collect():
        found.setdefault(r.question_id, {})[r["rank"]] = (r.complaint_id, r.hybrid_score)
    counts = {r.question_id: (r.candidate_count, r.returned_count, r.reason) for r in trace.collect()}
    for q, idx, x, vector, product, start, state in asked_rows:
        keep = [r for r in rows if (product is None or r[4].lower() == product) and (start is None or r[8] >= dt.datetime.fromisoformat(start)) and state is None]
        assert counts[q][0] == len(keep)
        if not keep:
            assert q not in found and counts[q][2] == "metadata_filter_returned_no_rows"
            continue
        lexical = np.array([sum(w * dict(zip(r[1], r[2])).get(t, 0) for t, w in zip(idx, x)) for r in keep])
        near = np.array([np.dot(r[3], vector) if r[3] else np.nan for r in keep])
        scale01 = lambda v: np.nan_to_num((v - np.nanmin(v)) / (np.nanmax(v) - np.nanmin(v)))
        fused = 0.52 * scale01(lexical) + 0.48 * scale01(near)
        best = sorted(zip(-fused, [r[0] for r in keep]))[:6]
        assert [found[q][i + 1][0] for i in range(len(best))] == [b[1] for b in best]
        assert [found[q][i + 1][1] for i in range(len(best))] == pytest.approx([-b[0] for b in best])


def min_max(values, every):
    known = every[np.isfinite(every)]
    if not known.size or known.max() <= known.min():
        return np.zeros_like(values)
    return np.nan_to_num((values - known.min()) / (known.max() - known.min()))


@pytest.mark.parametrize("weights", [(0.52, 0.48), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.3, 2.0)])
def test_band_holds_the_best_for_its_scale(weights):
    """Ties, unknown and constant scores; the band of parts that arrive one after the other is small and holds the k best of all."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        n, k = int(rng.integers(1, 400)), int(rng.integers(1, 9))
        lexical, dense = np.round(rng.random(n), rng.integers(0, 4)), np.round(rng.normal(size=n) / 4, rng.integers(1, 4))
        dense[rng.random(n) < rng.choice([0, 0.2, 1])] = np.nan
        keys = rng.permutation(n)
        band = hybrid.Band(1, k, *weights)
        for first in range(0, n, 97):
            part = slice(first, first + 97)
            band.add(0, np.ones((len(keys[part]), 1), bool), lexical[part, None], dense[part, None], pa.array(keys[part]))
        found = [np.asarray(c) for c in band.rows[0]]
        order = []
        for some, ids in (((lexical, dense), keys), (found[:2], found[2])):
            fused = np.round(weights[0] * min_max(some[0], lexical) + weights[1] * min_max(some[1], dense), 9)
            order.append(ids[np.lexsort((ids, -fused))][:k].tolist())
        assert order[0] == order[1]
    rows = hybrid.Band(1, 8, *weights)
    rows.add(0, np.ones((20_000, 1), bool), rng.random((20_000, 1)), rng.random((20_000, 1)), pa.array(np.arange(20_000)))
    assert len(rows.rows[0][2]) < 500


def test_more_questions_than_a_batch(spark, monkeypatch):
    monkeypatch.setattr(hybrid, "BATCH", 3)
    docs = spark.createDataFrame([(i, [i % 5], [1.0], [float(i % 7), 1.0]) for i in range(90)], "complaint_id long, idx array<int>, x array<double>, dense array<double>")
    docs = docs.withColumns({c: F.lit("v") for c in ("product", "company", "issue", "state")} | {"date_received": F.lit("2024-01-01").cast("timestamp_ntz")}).repartition(4)
    asked = hybrid.without_filters(spark.createDataFrame([(q, [q % 5], [1.0], [1.0, float(q)]) for q in range(10)], "question_id long, idx array<int>, x array<double>, dense array<double>"))
    one = sorted(map(tuple, hybrid.hybrid_search(docs, asked, 4)[0].collect()))
    monkeypatch.setattr(hybrid, "PASS", 4)
    evidence, trace = hybrid.hybrid_search(docs, asked, 4)
    assert sorted(map(tuple, evidence.collect())) == one and len(one) == 40 and trace.count() == 10


def test_blocks_below_the_best_scores_are_skipped():
    rng = np.random.default_rng(2)
    n_docs, n_terms = 5_000, 40
    matrix = np.where(rng.random((n_docs, n_terms)) < 0.1, rng.random((n_docs, n_terms)), 0.0)
    matrix[700:720] = 5 * rng.random((20, n_terms))
    docs, terms = np.nonzero(matrix)
    index = search.Postings(terms, docs, matrix[docs, terms], n_terms, n_docs)
    for _ in range(30):
        numbers = rng.choice(n_terms, 4, replace=False)
        weights = rng.random(4)
        scores = matrix[:, numbers] @ weights
        found, values = index.best(numbers, weights, 5, 0.0)
        assert np.allclose(values, scores[found]) and set(np.argsort(-scores)[:5]) <= set(found.tolist())
        assert len(set((found // search.BLOCK_DOCS).tolist())) < n_docs // search.BLOCK_DOCS // 4
        beyond = index.best(numbers, weights, 5, float(scores.max()))[0]
        assert scores.argmax() in beyond.tolist()


def test_questions_in_batches_of_terms(spark, monkeypatch):
    docs = small_docs(spark)
    asked = spark.createDataFrame([(q, f"word{q} word{q + 1} word{q}") for q in range(12)] + [(50, "nowhere"), (51, None)], "question_id long, question string")
    one = sorted(map(tuple, search.lexical_search(docs, asked, k=4).collect()))
    monkeypatch.setattr(search, "BATCH_TERMS", 5)
    monkeypatch.setattr(search, "BLOCK_DOCS", 3)
    again = sorted(map(tuple, search.lexical_search(docs, asked, k=4).collect()))
    assert [(r[0], r[1], r[3]) for r in one] == [(r[0], r[1], r[3]) for r in again] and len(one) == 14 * 4
    assert [r[2] for r in one] == pytest.approx([r[2] for r in again])


def test_index_round_trip(spark, tmp_path):
    docs = small_docs(spark).withColumn("consumer_complaint_narrative", F.col("clean_narrative")).drop("clean_narrative")
    index = hybrid.build_index(docs, str(tmp_path / "index"), components=6)
    asked = spark.createDataFrame([(1, "word1 word2 word3", "b")], "question_id long, question string, product string")
    first, _ = hybrid.retrieve(index, asked, 3)
    again, trace = hybrid.retrieve(hybrid.open_index(spark, str(tmp_path / "index")), asked, 3)
    rows = again.orderBy("rank").collect()
    assert rows == first.orderBy("rank").collect() and all(r.complaint_id % 3 == 0 for r in rows)
    assert trace.first().returned_count == 3 and 0 <= rows[0].hybrid_score <= 1 + 1e-12
    assert search.evidence(again, index.docs).first().citation.startswith("[CFPB Complaint ")


@pytest.mark.parametrize("kind", ["one bracket", "equal", "wide", "odd", "few", "none"])
def test_quantiles_of_any_spread(spark, kind, monkeypatch):
    rng = np.random.default_rng(6)
    values = {
        "one bracket": 1.0 + rng.random(30_000) * 1e-12, "equal": np.full(5_000, -3.5), "wide": rng.normal(size=20_000) * 10.0 ** rng.integers(-300, 300, 20_000),
        "odd": np.array([0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 1.0]), "few": np.array([2.0, 1.0]), "none": np.zeros(0)}[kind]
    monkeypatch.setattr(quantiles, "BRACKET", 50)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
    found = {r.probability: r.quantile for r in quantiles.exact_quantiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).collect()}
    if not values.size:
        assert found == {}
    for p, q in found.items():
        spot = p * (len(values) - 1)
        low, high = (np.sort(values)[i] for i in (math.floor(spot), math.ceil(spot)))
        assert q == pytest.approx(low + (high - low) * (spot - math.floor(spot)), rel=1e-12, nan_ok=True)


def test_profile_of_any_type(spark):
    rows = [(1, 0.0, "x" * 50, b"a", [1], dt.date(2024, 1, 1), True), (1, -0.0, "x" * 50, b"a", [1], None, None), (None, 1.5, "x" * 49 + "y", b"b", None, dt.date(2024, 1, 2), False),
            (2, float("nan"), None, None, [1, 2], None, None)]
    df = spark.createDataFrame(rows, "a long, b double, c string, d binary, `e f` array<int>, g date, h boolean")
    found = {r.field: (r.missing_count, r.unique_values) for r in quality.column_profile(df.drop("e f")).collect()}
    assert found == {"a": (1, 2), "b": (0, 3), "c": (1, 2), "d": (1, 2), "g": (2, 2), "h": (2, 2)}
    assert {r.position: r.n for r in quality.distinct_counts(df).collect()} == {0: 2, 1: 3, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2}
    assert {r.unique_values for r in quality.column_profile(df.select("a").limit(0)).collect()} == {0}


def test_names_that_cannot_win_are_not_compared():
    rng = np.random.default_rng(8)
    names = [f"supplier {i:09d} financial" for i in rng.permutation(3000)] + ["", "é ü"]
    index = entities.NameIndex(names)
    for query in ("customer 000000123", "", "zzz", "é", "supplier 000000007 financial", "x" * 70 + " supplier"):
        scores = [SequenceMatcher(None, query, n).ratio() for n in names]
        assert index.best(query) == (max(scores), int(np.argmax(scores)))
        assert index.best(query, 1.01) == (-1.0, -1)
    index.compared = 0
    for i in range(40):
        index.best(f"customer {i * 37:09d}")
    assert index.compared < 40 * len(names) / 10


def test_days_and_bounds_with_a_time(spark):
    moments = [dt.datetime(2024, 1, d, h, m) for d in (1, 2, 3) for h, m in ((0, 0), (0, 1), (9, 30), (23, 59))]
    rows = spark.createDataFrame([("P", "C", "I", "S", t, "closed", "Yes") for t in moments] + [("P", "C", "I", "S", None, "closed", "No")],
                                 "product string, company string, issue string, state string, date_received timestamp_ntz, company_response_to_consumer string, timely_response string")
    bounds = [(None, None), ("2024-01-02", None), (None, "2024-01-02"), ("2024-01-02 09:30:00", None), (None, "2024-01-03 00:01:00"), ("2024-01-02", "2024-01-02"), ("x", None)]
    asked = spark.createDataFrame([(i, "q", *b) for i, b in enumerate(bounds)], "question_id long, question string, date_start string, date_end string")
    found = {r.question_id: r.complaints for r in answers.question_analytics(rows, asked).collect()}
    for i, (start, end) in enumerate(bounds):
        known = lambda b: b and b != "x"
        inside = [t for t in moments if (not known(start) or t >= dt.datetime.fromisoformat(start)) and (not known(end) or t <= dt.datetime.fromisoformat(end))]
        assert found.get(i, 0) == len(inside) + (not known(start) and not known(end))


def test_router_goes_on_from_an_earlier_model(spark, tmp_path):
    rng = np.random.default_rng(3)
    words = {c: [f"{c}{i}" for i in range(8)] + [f"common{i}" for i in range(30)] for c in "AB"}
    rows = [(i, " ".join(rng.choice(words["AB"[i % 2]], size=12)) if i % 50 else "", "AB"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "complaint_id long, clean_narrative string, product string")
    first = router.train_router(docs, tol=1e-6)
    assert first.converged and first.gradient <= 1e-6 and first.report.first().converged
    first.write(spark, str(tmp_path / "router"))
    again = router.open_router(spark, str(tmp_path / "router"))
    assert again.terms == first.terms and np.allclose(again.coefficients, first.coefficients) and again.classes == first.classes
    steps = []
    fit = router.minimise
    router.minimise = lambda value, start, max_iter, tol: fit(lambda w: steps.append(1) or value(w), start, max_iter, tol)
    try:
        second = router.train_router(docs, tol=1e-6, start=again)
    finally:
        router.minimise = fit
    assert len(steps) <= 3 and np.allclose(second.coefficients, first.coefficients, atol=1e-3)
    assert [r.prediction for r in again.predict(docs.where("complaint_id < 3")).orderBy("complaint_id").collect()][1:] == ["B", "A"]
    with pytest.warns(UserWarning, match="gradient"):
        assert not router.train_router(docs, max_iter=1, tol=1e-9).converged


def test_gradient_of_the_router_vanishes_at_the_minimum():
    rng = np.random.default_rng(0)
    a, y = rng.normal(size=(200, 30)), rng.integers(0, 2, 200)

    def value(w):
        z = a @ w
        return float(np.mean(np.logaddexp(0, z) - y * z) + w @ w / 400), a.T @ (1 / (1 + np.exp(-z)) - y) / 200 + w / 200

    found, gradient = router.minimise(value, np.zeros(30), 1000, 1e-7)
    assert gradient <= 1e-7 and np.abs(value(found)[1]).max() <= 1e-7


def test_partials_count_like_the_rows(spark):
    rows = spark.createDataFrame([(dt.datetime(2022 + m // 12, m % 12 + 1, 1 + m % 5), f"P{m % 2}", None if m % 7 == 0 else f"I{k % 3}") for m in range(30) for k in range(1 + (m * m) % 11)]
                                 + [(None, "P0", "I0")], "date_received timestamp_ntz, product string, issue string")
    partials = metrics.monthly_partials(rows, "product", "issue")
    assert partials.count() < rows.count()
    for f in (lambda d: anomaly.emerging_scores(d, "issue"), lambda d: anomaly.detect_spikes(d, "product"), lambda d: metrics.volume_by_month(d, "issue"),
              lambda d: metrics.yoy_growth(d, "product"), opportunities.pair_counts, lambda d: metrics.top_categories(d, "issue")):
        assert sorted(map(str, f(partials).collect())) == sorted(map(str, f(rows).collect()))


def test_topics(spark):
    registry, assigned = topics.discover_topics(small_docs(spark, 15).withColumn("clean_narrative", F.lit("of the")))
    assert column(registry, "volume") == [15, *[0] * 11] and assigned.count() == 15 and set(column(registry, "top_terms")) == {""}
    registry, assigned = topics.discover_topics(small_docs(spark, 5), n_topics=2, spec=tfidf.TfidfSpec(500, 1), max_iter=5)
    assert assigned.count() == 5 and sum(column(registry, "volume")) == 5
    registry, assigned = topics.discover_topics(small_docs(spark), n_topics=3, spec=tfidf.TfidfSpec(500, 1), max_iter=5)
    assert assigned.count() == 40 and sum(column(registry, "volume")) == 40 and len(registry.first().top_terms.split(", ")) == 12


def test_topics_go_on_with_new_documents(spark, tmp_path):
    spec = tfidf.TfidfSpec(500, 1)
    rng = np.random.default_rng(9)
    groups = [[f"g{g}w{i}" for i in range(6)] for g in range(3)]
    rows = [(i, " ".join(rng.choice(groups[i % 3], size=10)), "A", "c") for i in range(120)]
    docs = spark.createDataFrame(rows, "complaint_id long, clean_narrative string, product string, company string")
    _, assigned = topics.discover_topics(docs.where("complaint_id < 90"), n_topics=3, spec=spec, path=str(tmp_path / "topics"))
    of = {r.complaint_id: r.topic_id for r in assigned.collect()}
    assert len({of[g] for g in range(3)}) == 3 and all(of[i] == of[i % 3] for i in of)
    model = topics.open_topics(spark, str(tmp_path / "topics"), spec)
    more, found = model.extended(docs.where("complaint_id >= 90"))
    assert {r.complaint_id: r.topic_id for r in found.collect()} == {i: of[i % 3] for i in range(90, 120)}
    assert more.sums.length == pytest.approx(120) and more.sums.error(more.components) <= more.sums.error(model.components) + 1e-9


def test_abstain_and_roll_up(spark):
    asked = spark.createDataFrame([(1, [], "abstain"), (2, ["t"], "retrieve"), (3, [], "abstain")], "question_id long, expected_terms array<string>, expected_behavior string") \
        .withColumns({f"expected_{f}": F.lit(None).cast("string") for f in ("product", "issue", "company")})
    evidence = spark.createDataFrame([(2, 7, 6, "has t", "p", "i", "c"), (3, 8, 1, "z", "p", "i", "c")],
                                     "question_id long, complaint_id long, rank int, clean_narrative string, product string, issue string, company string")
    trace = spark.createDataFrame([(1, 0), (2, 5), (3, 4)], "question_id long, candidate_count long")
    rows = {r.question_id: r for r in evaluation.question_report(evidence, asked, trace).collect()}
    assert (rows[1].recall_at_5, rows[2].recall_at_5, rows[2].recall_at_10, rows[3].recall_at_5) == (True, False, True, False)
    assert evaluation.roll_up(evaluation.question_report(evidence, asked, trace)).first().recall_at_10 == pytest.approx(2 / 3)


# --- models and decisions -----------------------------------------------------------------------------
def test_router_learns(spark):
    rows = [(i, " ".join([f"{'mortgage' if i % 2 else 'card'} item{i % 7}"] * 4), "M" if i % 2 else "C") for i in range(600)]
    docs = spark.createDataFrame(rows, "complaint_id long, clean_narrative string, product string")
    trained = router.train_router(docs, max_iter=20)
    report = trained.report.first()
    assert report.status == "trained" and report.model_macro_f1 > 0.95 > report.baseline_macro_f1
    assert router.train_router(docs.limit(100), min_class=20, max_iter=20).report.first().records == 100
    with pytest.raises(ValueError, match="two classes"):
        router.train_router(docs.where("product = 'M'"))


def test_majority_baseline_macro_f1(spark):
    rows = [("a", "a")] * 464 + [(f"c{i % 9}", "a") for i in range(864)]
    report = classification.summary_report(spark.createDataFrame(rows, "label string, prediction string")).first()
    assert report.macro_f1 == pytest.approx(0.0517857, abs=1e-6)


def test_stratified_split_with_hot_class(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("label"))
    rows = classification.stratified_split(df, "label", "id").groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert sum(r.n for r in rows) == 9000 and all(r.t == math.floor(r.n * 0.25 + 0.5) for r in rows)


def test_value_goldens(spark):
    base = spark.createDataFrame([(250_000, 24.0)], "observed_complaints long, hourly_wage double")
    rows = {r.scenario: r for r in value.scenario_table(base).collect()}
    expected = {"Conservative": (23958.0, -2310818.1968, -0.9718141), "Baseline": (101062.5, -1869070.7175, -0.8681793),
                "Aggressive": (248519.04, -1402368.1274, -0.6611104)}
    for name, (capacity, npv, roi) in expected.items():
        assert (rows[name].estimated_annual_capacity_value, rows[name].npv, rows[name].roi) == pytest.approx((capacity, npv, roi), rel=1e-6)
        assert math.isinf(rows[name].payback_years)
    idle = value.calculate_value(base.withColumn("adoption_rate", F.lit(0.0))).first()
    assert idle.expected_hours_released == 0 and idle.annual_net_value < 0
    free = value.calculate_value(base.withColumns({"implementation_cost": F.lit(0.0), "annual_operating_cost": F.lit(0.0)})).first()
    assert free.roi is None
    twice = value.sensitivity(base.union(base))
    assert twice.count() == 16 and twice.orderBy(F.desc("range")).first()["range"] > 0


def test_opportunities(spark):
    pairs = [("Card", "Late fee")] * 6 + [("Card", None)] * 4 + [("Bank", "Account closed")] * 2
    rows = opportunities.derive_opportunities(spark.createDataFrame(pairs, "product string, issue string")).orderBy(F.desc("supporting_data")).collect()
    assert [(r.opportunity_name, r.supporting_data) for r in rows] == [
        ("Root-cause detection", 6), ("Operational intelligence workbench", 4), ("Agent-assist retrieval", 2)]


def test_terms_travel_as_one_value_per_document(spark, monkeypatch):
    import re
    from collections import Counter, defaultdict

    import numpy as np

    monkeypatch.setattr(tfidf, "PART_TERMS", 50)
    monkeypatch.setattr(tfidf, "HELD_TERMS", 40)
    monkeypatch.setattr(tfidf, "HEAD_TERMS", 6)
    draw = np.random.default_rng(4)
    names = [f"w{i}é" for i in range(40)] + ["the", "of"]
    texts = [" ".join(names[i] for i in (42 * draw.random(n) ** 2).astype(int)) for n in draw.integers(0, 30, 80)] + [None, "", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)
    spec = tfidf.TfidfSpec(max_features=None, min_df=2, stop_words=("the", "of"))
    counts = tfidf.count_terms(docs, "id", "text", spec)
    assert [f.dataType.simpleString() for f in counts.schema] == ["bigint", "string", "binary"]
    df, cf, want = Counter(), Counter(), {}
    for i, text in enumerate(texts):
        words = [w for w in re.findall(r"\w\w+", text or "") if w not in spec.stop_words]
        want[i] = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        df.update(want[i].keys())
        cf.update(want[i])
    have = defaultdict(Counter)
    for r in tfidf.occurrences(counts, "id").collect():
        have[r["id"]][r["term"]] += r["tf"]
    assert have == {i: c for i, c in want.items() if c}
    assert tfidf.parts_of(counts) > 3
    vocab = tfidf.vocabulary(counts, spec).cache()
    known = {r["term"]: (r["df"], r["cf"], r["idf"]) for r in vocab.collect()}
    assert {t: v[:2] for t, v in known.items()} == {t: (n, cf[t]) for t, n in df.items() if n >= 2}
    lengths = {r["id"]: r["norm"] for r in tfidf.norms(counts, vocab, "id", spec).collect()}
    squares = {i: sum((n * known[t][2]) ** 2 for t, n in c.items() if t in known) for i, c in want.items()}
    assert lengths == pytest.approx({i: s ** 0.5 for i, s in squares.items() if s})


def test_split_leaves_rows_where_they_are(spark):
    from casemill.operators import classification

    rows = spark.range(400).selectExpr("id AS key", "concat('c', id % 2) AS label", "repeat('x', 5) AS text").repartition(4)
    split = classification.stratified_split(classification.eligible_classes(rows, "label", 10), "label", "key")
    assert split.where("is_test").count() == 100
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan.split("Join LeftOuter", 1)[1].split("\n", 1)[0]
