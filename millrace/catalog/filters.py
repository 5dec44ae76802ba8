"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import ORDER_VALUES_SQL, big, day, money, ntz, order_values, real, text
from millrace.operators import filters as X
from millrace.registry import query


@query(
    "project_expressions",
    oracle="""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line,
           l_returnflag || '-' || l_linestatus AS flags,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net
    FROM lineitem
    """,
)
def project_expressions(t):
    net = money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return t.lineitem.select(
        "l_orderkey",
        big("l_linenumber").alias("line"),
        F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("flags"),
        real(net).alias("net"),
    )


@query(
    "lateral_alias_reuse",
    oracle="""
    SELECT o_orderkey, CAST(y AS BIGINT) AS yr, strftime(make_date(y, 1, 1), '%Y-%m-%d') AS first_day,
           strftime(make_date(y, 12, 31), '%Y-%m-%d') AS last_day,
           date_diff('day', make_date(y, 1, 1), d) AS days_in
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y FROM orders)
    """,
)
def lateral_alias_reuse(t):
    return t.sql(
        """
        SELECT o_orderkey, yr, cast(b AS string) AS first_day, cast(e AS string) AS last_day, days_in
        FROM (SELECT o_orderkey, to_date(o_orderdate) AS d, cast(year(d) AS bigint) AS yr,
                     make_date(int(yr), 1, 1) AS b, make_date(int(yr), 12, 31) AS e,
                     cast(datediff(d, b) AS bigint) AS days_in
              FROM {orders})
        """
    )


@query(
    "derived_table_chain",
    oracle=f"""
    WITH v AS ({ORDER_VALUES_SQL}),
    c AS (SELECT year(odate) AS yr, o_custkey, SUM(val) AS total FROM v GROUP BY 1, 2),
    n AS (SELECT yr, COUNT(*) AS custs, MAX(total) AS best FROM c GROUP BY yr)
    SELECT CAST(a.yr AS BIGINT) AS yr, a.custs, b.custs AS prev_custs, CAST(a.best AS DOUBLE) AS best
    FROM n a LEFT JOIN n b ON a.yr = b.yr + 1
    """,
)
def derived_table_chain(t):
    per_customer = (
        order_values(t).groupBy(F.year("odate").alias("yr"), "o_custkey").agg(F.sum("val").alias("total"))
    )
    yearly = per_customer.groupBy("yr").agg(F.count(F.lit(1)).alias("custs"), F.max("total").alias("best"))
    before = yearly.select((F.col("yr") + 1).alias("yr"), F.col("custs").alias("prev_custs"))
    return yearly.join(before, "yr", "left").select(
        big("yr").alias("yr"), "custs", "prev_custs", real("best").alias("best")
    )


@query(
    "filter_comparison",
    oracle="""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderstatus <> 'F' AND o_totalprice > 250000 AND o_orderdate < TIMESTAMP '1998-01-01'
    """,
)
def filter_comparison(t):
    return t.orders.where(
        (F.col("o_orderstatus") != "F") & (F.col("o_totalprice") > 250000) & (F.col("o_orderdate") < ntz("1998-01-01"))
    ).select("o_orderkey", "o_custkey")


@query(
    "filter_between_in",
    oracle="""
    SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_type FROM part
    WHERE p_size BETWEEN 10 AND 20 AND p_type IN ('ECONOMY', 'PROMO', 'STANDARD')
    """,
)
def filter_between_in(t):
    kept = t.part.where(F.col("p_size").between(10, 20) & F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD"))
    return kept.select("p_partkey", big("p_size").alias("p_size"), "p_type")


@query(
    "filter_or_columns",
    oracle="""
    SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS line FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-07'
       OR l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-07'
    """,
)
def filter_or_columns(t):
    low, high = ntz("1998-01-01"), ntz("1998-01-07")
    joined = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    kept = joined.where(F.col("o_orderdate").between(low, high) | F.col("l_shipdate").between(low, high))
    return kept.select("o_orderkey", big("l_linenumber").alias("line"))


@query(
    "date_halfopen_range",
    oracle="""
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'
    """,
)
def date_halfopen_range(t):
    return t.events.where(X.day_range("ts", "2024-01-10", "2024-01-11")).select("event_id", "event_type")


@query(
    "like_prefix",
    oracle="SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%' AND p_name LIKE '%et'",
)
def like_prefix(t):
    return t.part.where(F.col("p_name").startswith("s") & F.col("p_name").endswith("et")).select("p_partkey", "p_name")


@query(
    "like_literal_prefix",
    oracle="""
    SELECT p_partkey, subject FROM
      (SELECT p_partkey, CASE WHEN p_size > 25 THEN '[' || p_type || '] ' || p_name
                              ELSE CAST(p_size AS VARCHAR) || '% ' || p_name END AS subject FROM part)
    WHERE starts_with(subject, '[EC') OR starts_with(subject, '5%')
    """,
)
def like_literal_prefix(t):
    subject = F.when(
        F.col("p_size") > 25, F.concat(F.lit("["), "p_type", F.lit("] "), "p_name")
    ).otherwise(F.concat(text("p_size"), F.lit("% "), "p_name"))
    messages = t.part.select("p_partkey", subject.alias("subject"))
    return messages.where(X.starts_with_text("subject", "[EC") | X.starts_with_text("subject", "5%"))


@query(
    "like_or_equal_switch",
    oracle="""
    SELECT 'pattern' AS form, c_custkey FROM customer WHERE c_mktsegment LIKE 'M%Y'
    UNION ALL SELECT 'exact', c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def like_or_equal_switch(t):
    forms = {"pattern": "M%Y", "exact": "BUILDING"}
    pattern, exact = [
        t.customer.where(X.like_or_equal("c_mktsegment", arg)).select(F.lit(form).alias("form"), "c_custkey")
        for form, arg in forms.items()
    ]
    return pattern.unionByName(exact)


@query(
    "optional_filters",
    oracle="""
    WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus AS status FROM orders)
    SELECT 'or_form' AS form, o_orderkey FROM o WHERE status = 'F'
    UNION ALL SELECT 'coalesce_form', o_orderkey FROM o WHERE status = 'F' AND priority = priority
    """,
)
def optional_filters(t):
    rows = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    wanted = {"status": "F", "priority": None}
    a = X.optional_filters(rows, **wanted).select(F.lit("or_form").alias("form"), "o_orderkey")
    b = X.optional_filters_coalesced(rows, **wanted).select(F.lit("coalesce_form").alias("form"), "o_orderkey")
    return a.unionByName(b)


@query(
    "safe_cast_filter",
    oracle="""
    SELECT event_id, strftime(try_strptime(txt, '%Y%m%d'), '%Y-%m-%d') AS d
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'Wrong Date' ELSE strftime(ts, '%Y%m%d') END AS txt FROM events)
    WHERE try_strptime(txt, '%Y%m%d') >= TIMESTAMP '2024-01-15'
    """,
)
def safe_cast_filter(t):
    dirty = F.when(F.col("event_type") == "error", "Wrong Date").otherwise(F.date_format("ts", "yyyyMMdd"))
    parsed = t.events.select("event_id", F.try_to_date(dirty, "yyyyMMdd").alias("date"))
    return parsed.where(F.col("date") >= F.lit("2024-01-15").cast("date")).select("event_id", day("date").alias("d"))


@query(
    "null_coalesce",
    oracle="""
    SELECT p_partkey, CAST(COALESCE(hourly * 40 * 52, salary, commission * 12) AS DOUBLE) AS total FROM
      (SELECT p_partkey, CASE WHEN p_size < 15 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS hourly,
              CASE WHEN p_size < 30 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS salary,
              CASE WHEN p_size < 45 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS commission FROM part)
    """,
)
def null_coalesce(t):
    below = lambda n: F.when(F.col("p_size") < n, money("p_retailprice"))
    total = F.coalesce(below(15) * 40 * 52, below(30), below(45) * 12)
    return t.part.select("p_partkey", real(total).alias("total"))


@query(
    "isnull_first_type",
    oracle="""
    SELECT o_orderkey, COALESCE(left(nullif(o_orderstatus, 'P'), 1), left(o_orderpriority, 1)) AS short_form,
           COALESCE(nullif(o_orderstatus, 'P'), o_orderpriority) AS full_form
    FROM orders
    """,
)
def isnull_first_type(t):
    """ISNULL cuts the substitute to the first argument's length (here one character)."""
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select(
        "o_orderkey",
        F.coalesce(status, F.substring("o_orderpriority", 1, 1)).alias("short_form"),
        F.coalesce(status, "o_orderpriority").alias("full_form"),
    )


@query(
    "case_expression",
    oracle="""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status,
           CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'high' END AS band,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'old' ELSE 'new' END AS age
    FROM orders
    """,
)
def case_expression(t):
    return t.sql(
        """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status,
               CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'high' END AS band,
               if(o_orderdate < timestamp_ntz '1998-01-01', 'old', 'new') AS age
        FROM {orders}
        """
    )


@query(
    "in_subquery",
    oracle="""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS odate FROM orders
    WHERE o_orderdate IN (SELECT MAX(o_orderdate) FROM orders GROUP BY year(o_orderdate), month(o_orderdate))
    """,
)
def in_subquery(t):
    last = t.orders.groupBy(F.year("o_orderdate"), F.month("o_orderdate")).agg(F.max("o_orderdate").alias("o_orderdate"))
    return t.orders.join(last.select("o_orderdate"), "o_orderdate", "left_semi").select(
        "o_orderkey", day("o_orderdate").alias("odate")
    )


@query(
    "not_in_null_aware",
    oracle="""
    WITH u AS (SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS k FROM lineitem)
    SELECT 'with_null' AS variant, o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM u)
    UNION ALL
    SELECT 'null_removed', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT k FROM u WHERE k IS NOT NULL)
    """,
)
def not_in_null_aware(t):
    """Orders without a line that was kept; returned lines do not name their order."""
    used = t.lineitem.select(F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("k"))
    forms = {"with_null": used, "null_removed": used.where(F.col("k").isNotNull())}
    a, b = [
        X.not_in(t.orders, "o_orderkey", values, "k").select(F.lit(name).alias("variant"), "o_orderkey")
        for name, values in forms.items()
    ]
    return a.unionByName(b)


@query(
    "scalar_subquery_filter",
    oracle="""
    SELECT p_partkey, p_retailprice FROM part
    WHERE CAST(p_retailprice AS DOUBLE) >
      (SELECT CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) FROM part)
    """,
)
def scalar_subquery_filter(t):
    average = t.part.agg(real(F.sum(money("p_retailprice"))) / F.count(F.lit(1))).scalar()
    return t.part.where(F.col("p_retailprice") > average).select("p_partkey", "p_retailprice")


@query(
    "correlated_max_filter",
    oracle="""
    SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS odate FROM orders o
    WHERE o_orderkey = (SELECT i.o_orderkey FROM orders i WHERE i.o_custkey = o.o_custkey
                        ORDER BY i.o_orderdate DESC, i.o_orderkey DESC LIMIT 1)
    """,
)
def correlated_max_filter(t):
    """Latest order per customer, the higher key winning a tie: a max of structs."""
    latest = t.orders.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m"))
    return latest.select("o_custkey", F.col("m.o_orderkey"), day("m.o_orderdate").alias("odate"))


@query(
    "correlated_count",
    oracle="""
    SELECT o_orderkey, (SELECT COUNT(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_lines FROM orders
    """,
)
def correlated_count(t):
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    joined = t.orders.join(counts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select("o_orderkey", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_lines"))


@query(
    "scalar_assign_guard",
    oracle="""
    SELECT c_custkey, (SELECT r_name FROM region WHERE r_regionkey = 2) AS found,
           (SELECT r_name FROM region WHERE r_regionkey = 99) AS missing
    FROM customer
    """,
)
def scalar_assign_guard(t):
    region = lambda key: X.single_value(t.region.where(F.col("r_regionkey") == key), "r_name")
    return t.customer.select("c_custkey", region(2).alias("found"), region(99).alias("missing"))


@query("distinct_rows", oracle="SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query(
    "end_of_year_filter",
    oracle="""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS odate FROM orders
    WHERE CAST(o_orderdate AS DATE) IN (make_date(year(o_orderdate), 12, 31), make_date(year(o_orderdate), 1, 1))
    """,
)
def end_of_year_filter(t):
    date = F.to_date("o_orderdate")
    edge = lambda m, d: F.make_date(F.year(date), F.lit(m), F.lit(d))
    return t.orders.where((date == edge(12, 31)) | (date == edge(1, 1))).select("o_orderkey", day(date).alias("odate"))
