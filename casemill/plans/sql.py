"""Pieces shared by the oracle SQL."""

CASES = """cases AS (
  SELECT o_orderkey AS complaint_id, o_orderdate AS date_received, c_mktsegment AS product, o_orderpriority AS issue,
         c_name AS company, n_name AS state, nullif(o_orderstatus, 'P') AS company_response_to_consumer,
         CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' END AS timely_response,
         CASE WHEN o_totalprice > 250000 THEN 'Phone' ELSE 'Web' END AS submitted_via,
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS consumer_complaint_narrative,
         o_totalprice AS assets
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

MONTHLY = """monthly AS (
  SELECT CAST(date_trunc('month', date_received) AS DATE) AS month, count(*) AS complaints
  FROM cases WHERE date_received IS NOT NULL GROUP BY 1
)"""


def monthly_by(group: str) -> str:
    return f"""monthly AS (
  SELECT CAST(date_trunc('month', date_received) AS DATE) AS month, {group}, count(*) AS complaints
  FROM cases WHERE date_received IS NOT NULL GROUP BY 1, 2
)"""


def spikes(group: str, min_history: int) -> str:
    """CTEs ending in ``spikes``: trailing 12-row baseline per group."""
    return f"""{CASES}, {monthly_by(group)},
baseline AS (
  SELECT *, CASE WHEN count(*) OVER w >= {min_history} THEN avg(complaints) OVER w END AS baseline_mean,
         CASE WHEN count(*) OVER w >= {min_history} THEN stddev_pop(complaints) OVER w END AS baseline_std
  FROM monthly WHERE {group} IS NOT NULL
  WINDOW w AS (PARTITION BY {group} ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
), spikes AS (
  SELECT *, (complaints - baseline_mean) / nullif(baseline_std, 0) AS z_score FROM baseline
)"""


def scores(group: str) -> str:
    """CTEs ending in ``scores``: emerging score of the latest month."""
    return f"""{spikes(group, 4)},
latest AS (SELECT *, greatest(coalesce(z_score, 0), 0) AS growth_component FROM spikes
           WHERE month = (SELECT max(month) FROM spikes)),
scores AS (
  SELECT *, complaints / CAST((SELECT max(complaints) FROM latest) AS DOUBLE) AS volume_component,
         round_even(0.65 * growth_component
           + 0.35 * (complaints / CAST((SELECT max(complaints) FROM latest) AS DOUBLE)), 3) AS emerging_issue_score
  FROM latest
)"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
