"""The business questions as SQL text, for views stored in the catalog.

A stored view outlives the session and answers from the current load of its tables. Each
gives what the function of its name in ``gold`` gives for the same tables.
"""

from __future__ import annotations

from abonados.plans import checks as K

_TABLES = {"analytics": K.ANALYTICS, "payments": K.PAYMENTS, "services": K.SERVICES, "dim": K.DIM_SERVICES}
_ARPU = "round(avg(arpu_estimated), 2)"


def _share(status: str) -> str:
    return f"round(100.0BD * sum(`{status}`) / sum(total), 2) AS pct_{status.lower()}"


def _count(status: str) -> str:
    return f"count_if(payment_status = '{status}') AS `{status}`"


_STATUSES = ("COMPLETED", "FAILED", "PENDING", "LATE")

#: Sets of services as sorted arrays of numbers, with customers and revenue; their text
#: is made once for each set.
_SETS = """
WITH per_customer AS (
  SELECT customer_id, array_sort(collect_set(service_id)) AS numbers
  FROM {{services}} LEFT SEMI JOIN {{dim}} USING (service_id) GROUP BY customer_id
), sets AS (
  SELECT numbers, count(*) AS customers,
    sum(coalesce(total_revenue, CAST(0 AS decimal(18,6)))) AS total_revenue,
    round(avg(coalesce(arpu_estimated, CAST(0 AS decimal(32,10)))), 2) AS avg_arpu
  FROM per_customer {join} JOIN {{analytics}} USING (customer_id) GROUP BY numbers
), named AS (
  SELECT listagg(service_code, ',') WITHIN GROUP (ORDER BY service_code) AS service_combo,
    count(*) AS services_count, customers, total_revenue, avg_arpu
  FROM (SELECT *, explode(numbers) AS service_id FROM sets) JOIN {{dim}} USING (service_id)
  GROUP BY numbers, customers, total_revenue, avg_arpu
)"""

#: Exact median and mode without a group's values in one task. A sketch brackets the
#: middle, counts of equal values below, inside and above it tell where the median lies,
#: and only values from there are ranked. The ranges are facts, whatever the sketch says.
_REVENUE_STATS = """
WITH sketch AS (
  SELECT plan_type, operator, avg(arpu_estimated) AS mean, count(*) AS total,
    percentile_approx(CAST(arpu_estimated AS double), array(0.4996D, 0.5004D), 10000) AS bracket
  FROM {analytics} WHERE arpu_estimated IS NOT NULL GROUP BY plan_type, operator
), counts AS (
  SELECT plan_type, operator, arpu_estimated AS value, count(*) AS n
  FROM {analytics} WHERE arpu_estimated IS NOT NULL GROUP BY ALL
), zones AS (
  SELECT c.plan_type, c.operator, sum(n) AS held, min(value) AS least, max(value) AS most,
    max(struct(n, -value AS low, value)) AS top, max(mean) AS mean, max(total) AS total,
    CASE WHEN CAST(value AS double) < bracket[0] THEN -1 WHEN CAST(value AS double) > bracket[1] THEN 1 ELSE 0 END AS zone
  FROM counts c JOIN sketch s ON c.plan_type <=> s.plan_type AND c.operator <=> s.operator
  GROUP BY c.plan_type, c.operator, zone
), summed AS (
  SELECT *, sum(held) OVER (PARTITION BY plan_type, operator ORDER BY zone) AS upto FROM zones
), located AS (
  SELECT *, upto >= (total + 1) DIV 2 AND upto - held < (total + 2) DIV 2 AS holds FROM summed
), ranges AS (
  SELECT plan_type, operator, min(least) FILTER (WHERE holds) AS least, max(most) FILTER (WHERE holds) AS most,
    min(upto - held) FILTER (WHERE holds) AS before, max(top) AS top, max(mean) AS mean, max(total) AS total
  FROM located GROUP BY plan_type, operator
), ranked AS (
  SELECT r.*, value, n, before + sum(n) OVER (PARTITION BY c.plan_type, c.operator ORDER BY value) AS upto
  FROM counts c JOIN ranges r ON c.plan_type <=> r.plan_type AND c.operator <=> r.operator
  WHERE value BETWEEN least AND most
), middle AS (
  SELECT plan_type, operator, max(mean) AS mean, max(total) AS total, max(top).value AS mode,
    max(CAST(value AS double)) FILTER (WHERE upto >= (total + 1) DIV 2 AND upto - n < (total + 1) DIV 2) AS lo,
    max(CAST(value AS double)) FILTER (WHERE upto >= (total + 2) DIV 2 AND upto - n < (total + 2) DIV 2) AS hi
  FROM ranked GROUP BY plan_type, operator
)
SELECT plan_type, operator, round(mean, 2) AS mean_revenue, lo + (hi - lo) * 0.5D AS median_revenue,
  mode AS mode_revenue, total AS customers
FROM middle ORDER BY mean_revenue DESC NULLS FIRST"""


def _counted(keys: str, order: str, more: str = "", where: str = "", count: str = "customers", month: bool = False) -> str:
    """Customers by keys, and by ``month`` before them."""
    first, by = (f"{_MONTH}, ", "month, ") if month else ("", "")
    chosen, named = (first + keys).rstrip(", "), (by + keys).rstrip(", ")
    return f"SELECT {chosen}, count(*) AS {count}{more} FROM {{analytics}}{where} GROUP BY {named} ORDER BY {order}"


_MONTH = "date_trunc('month', registration_date) AS month"
_MOST = "customers DESC NULLS FIRST"
_KNOWN = " WHERE device_brand <> 'Unknown'"


def _last(*names: str) -> str:
    return ", ".join(f"{name} ASC NULLS LAST" for name in names)


TEXTS: dict[str, str] = {
    "acquisition_trends_operator": _counted("operator", _last("month", "operator"), count="new_customers", month=True),
    "age_dist_country_operator": _counted("country, operator, age_bucket", _last("country", "operator", "age_bucket")),
    "age_distribution_by_plan": _counted("plan_type, age_bucket", _last("plan_type", "age_bucket")),
    "arpu_by_plan_type": f"""SELECT plan_type, {_ARPU} AS arpu FROM {{analytics}}
        WHERE arpu_estimated IS NOT NULL GROUP BY plan_type ORDER BY arpu DESC NULLS FIRST""",
    "credit_score_distribution": _counted("credit_score_range", _MOST, f", {_ARPU} AS avg_arpu"),
    "credit_score_vs_payment_behavior": f"""
        WITH per_customer AS (
          SELECT customer_id, count(*) AS total, {", ".join(map(_count, _STATUSES))}
          FROM {{payments}} GROUP BY customer_id)
        SELECT credit_score_range, sum(total) AS total_payments, {", ".join(map(_share, _STATUSES))}
        FROM per_customer JOIN {{analytics}} USING (customer_id)
        GROUP BY credit_score_range ORDER BY {_last("credit_score_range")}""",
    "customer_status_distribution": f"""
        SELECT *, round(customers * 100.0BD / sum(customers) OVER (), 2) AS pct_total
        FROM ({_counted("customer_status", _MOST)}) ORDER BY {_MOST}""",
    "customers_by_geo": _counted("country, city", _MOST),
    "customers_by_operator": _counted("operator", _MOST, f", {_ARPU} AS avg_arpu"),
    "customers_pending_payments": """
        SELECT customer_id, plan_type, operator, country, city, total_revenue, arpu_estimated
        FROM {analytics} WHERE has_pending_payments""",
    "device_brand_by_country_operator": _counted("country, operator, device_brand", _MOST, where=_KNOWN),
    "device_brand_by_plan_type": _counted("plan_type, device_brand", f"{_last('plan_type')}, {_MOST}", where=_KNOWN),
    "device_brand_popularity": _counted("device_brand", _MOST, where=_KNOWN),
    "new_customers_over_time": _counted("", _last("month"), count="new_customers", month=True),
    "payment_issues_pct": """
        SELECT round(CAST(count_if(has_payment_issues) AS decimal(20,0)) / nullif(count(*), 0) * 100, 2)
          AS pct_payment_issues FROM {analytics}""",
    "revenue_by_geo": f"""SELECT country, city, sum(total_revenue) AS total_revenue, count(*) AS customers, {_ARPU} AS avg_arpu
        FROM {{analytics}} GROUP BY country, city ORDER BY total_revenue DESC NULLS FIRST""",
    "revenue_stats_plan_operator": _REVENUE_STATS,
    "service_combinations_popularity": _SETS.format(join="INNER") + f"""
        SELECT service_combo, services_count, customers, total_revenue, avg_arpu,
          round(customers * 100.0BD / sum(customers) OVER (), 2) AS pct_customers
        FROM named ORDER BY {_MOST}""",
    "service_combo_revenue": _SETS.format(join="LEFT") + """
        SELECT service_combo, services_count, total_revenue, avg_arpu, customers
        FROM named ORDER BY total_revenue DESC NULLS FIRST""",
    "services_popularity": f"""
        SELECT service_code, count(DISTINCT customer_id) AS customers,
          round(count(DISTINCT customer_id) * 100.0BD / (SELECT count(DISTINCT customer_id) FROM {{analytics}}), 2) AS penetration_pct
        FROM {{services}} JOIN {{dim}} USING (service_id) GROUP BY service_code ORDER BY {_MOST}""",
}


def text(name: str, tables: dict[str, str]) -> str:
    """The text of a view over tables of these names in the catalog, by the models' names."""
    return TEXTS[name].format(**{short: tables[model] for short, model in _TABLES.items() if model in tables})
