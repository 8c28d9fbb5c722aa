"""Queries of the customer analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import customers, kpi
from tidewell.plans import queries as q

#: The day from which recency and age count.
AS_OF = 20020101
_RFM = f"""SELECT customer_id, CAST(DATE '2002-01-01' - strptime(CAST(max(order_date_id) AS VARCHAR), '%Y%m%d')::DATE AS BIGINT) AS recency, count(DISTINCT sales_order_id) AS frequency, sum(net_sales) AS money FROM fact GROUP BY 1"""
_SEGMENT = " ".join(f"WHEN r >= {r} AND f >= {f} AND m >= {m} THEN '{name}'" for name, r, f, m in customers.SEGMENTS)


@q.query(
    "customer_segments",
    f"""SELECT customer_id, recency, frequency, CAST(money AS DOUBLE) AS money, r, f, m, CASE {_SEGMENT} END AS segment FROM (SELECT *, ntile(5) OVER (ORDER BY recency DESC, customer_id) AS r,
    ntile(5) OVER (ORDER BY frequency, customer_id) AS f, ntile(5) OVER (ORDER BY money, customer_id) AS m FROM ({_RFM}))""",
    "fact",
)
def customer_segments(t):
    return customers.segments(customers.scores(kpi.rfm(q.fact(t), AS_OF, exact=True)))


_ACTIVE = "SELECT DISTINCT customer_id, year(order_date) * 12 + month(order_date) - 1 AS m FROM header WHERE order_date IS NOT NULL AND customer_id IS NOT NULL"
_FIRST = f"SELECT customer_id, min(m) AS first FROM ({_ACTIVE}) GROUP BY 1"
_TEXT = "printf('%04d-%02d', {0} // 12, {0} % 12 + 1)"


@q.query(
    "cohort_retention",
    f"""SELECT {_TEXT.format("first")} AS cohort, CAST(m - first AS BIGINT) AS months_later, count(*) AS customers, round(CAST(count(*) AS DOUBLE) / n, 6) AS share
    FROM ({_ACTIVE}) JOIN ({_FIRST}) USING (customer_id) JOIN (SELECT first, count(*) AS n FROM ({_FIRST}) GROUP BY 1) USING (first) GROUP BY first, m, n""",
    "header",
)
def cohort_retention(t):
    return customers.retention(*customers.activity(t.header()))


@q.query(
    "churn_by_month",
    f"""SELECT {_TEXT.format("x.m")} AS month, count(a.customer_id) AS active, count(*) FILTER (WHERE a.m = first) AS new, count(*) FILTER (WHERE a.m > first) AS returning,
    CAST(any_value((SELECT count(*) FROM ({_ACTIVE}) b WHERE b.m = x.m - 3 AND NOT EXISTS (SELECT 1 FROM ({_ACTIVE}) c WHERE c.customer_id = b.customer_id AND c.m > x.m - 3 AND c.m <= x.m))) AS BIGINT) AS churned
    FROM (SELECT unnest(generate_series(min(m), max(m))) AS m FROM ({_ACTIVE})) x LEFT JOIN ({_ACTIVE}) a ON a.m = x.m LEFT JOIN ({_FIRST}) f ON f.customer_id = a.customer_id GROUP BY x.m""",
    "header",
)
def churn_by_month(t):
    return customers.churn(*customers.activity(t.header()))


@q.query("customer_lifetime_value")
def customer_lifetime_value(t):
    """The fit has no SQL; the tests hold it against a brute-force one."""
    known = customers.purchases(t.header(), F.lit("2002-01-01").cast("date"))
    return customers.lifetime_value(known, customers.fit(known), 365)
