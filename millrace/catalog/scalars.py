"""Scalar functions over table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big, day, money, second, text
from millrace.functions import dates as D
from millrace.functions import text as X
from millrace.registry import query


@query(
    "fn_string",
    oracle="""
    SELECT p_partkey, left(p_name, 3) AS l3, right(p_name, 3) AS r3, substr(p_name, 2, 4) AS mid,
           length(rtrim(p_name || '   ')) AS len, CAST(instr(p_name, 'e') AS BIGINT) AS pos_e,
           left(p_name, 1) || '**' || substr(p_name, 4) AS stuffed, replace(p_name, ' ', '_') AS replaced,
           repeat('ab', 3) || upper(p_name) AS up, '[' || replace(p_brand || ']', ']', ']]') || ']' AS quoted,
           reverse(p_name) AS rev, trim('  ' || p_name || ' ') AS trimmed, p_name || nullif(p_type, 'PROMO') AS joined
    FROM part
    """,
)
def fn_string(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        F.left(name, F.lit(3)).alias("l3"),
        F.right(name, F.lit(3)).alias("r3"),
        F.substring(name, 2, 4).alias("mid"),
        big(X.length_trimmed(F.concat(name, F.lit("   ")))).alias("len"),
        big(F.locate("e", name)).alias("pos_e"),
        X.stuff(name, 2, 2, "**").alias("stuffed"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("replaced"),
        F.concat(F.repeat(F.lit("ab"), 3), F.upper(name)).alias("up"),
        X.quote_name(F.concat("p_brand", F.lit("]"))).alias("quoted"),
        F.reverse(name).alias("rev"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.concat(name, F.nullif("p_type", F.lit("PROMO"))).alias("joined"),
    )


@query(
    "fn_split_to_rows",
    oracle=r"""
    WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
    k AS (SELECT 'all' AS form, doc_id, a FROM p UNION ALL
          SELECT 'non_empty', doc_id, list_filter(a, lambda x: x <> '') FROM p)
    SELECT form, doc_id, pos, a[pos] AS element FROM (SELECT form, doc_id, a, unnest(range(1, len(a) + 1)) AS pos FROM k)
    """,
)
def fn_split_to_rows(t):
    docs = t.documents.select("doc_id", "text")
    both = [
        X.split_to_rows(docs, "text", "\n", keep).select(F.lit(form).alias("form"), "doc_id", "pos", "element")
        for form, keep in (("all", True), ("non_empty", False))
    ]
    return both[0].unionByName(both[1])


@query(
    "fn_remove_chars",
    oracle="SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits FROM customer",
)
def fn_remove_chars(t):
    return t.customer.select("c_custkey", X.remove_matching(F.col("c_name"), "[^0-9]").alias("digits"))


@query(
    "fn_regex_replace",
    oracle=r"SELECT s_suppkey, regexp_replace(s_name, '^(Supp)lier#0*', '\1-', 'g') AS short FROM supplier",
)
def fn_regex_replace(t):
    return t.supplier.select("s_suppkey", F.regexp_replace("s_name", "^(Supp)lier#0*", "$1-").alias("short"))


@query(
    "fn_date_parts",
    oracle="""
    SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m,
           CAST(quarter(o_orderdate) AS BIGINT) AS q, CAST(day(o_orderdate) AS BIGINT) AS d,
           strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%A') AS day_name
    FROM orders
    """,
)
def fn_date_parts(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        big(F.year(d)).alias("y"),
        big(F.month(d)).alias("m"),
        big(F.quarter(d)).alias("q"),
        big(F.dayofmonth(d)).alias("d"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
    )


@query(
    "fn_date_arith",
    oracle="""
    SELECT o_orderkey, CAST(l_linenumber AS BIGINT) AS line,
           strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
           strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d') AS in_ten_days,
           date_diff('day', o_orderdate, l_shipdate) AS days, date_diff('month', o_orderdate, l_shipdate) AS months,
           date_diff('year', o_orderdate, l_shipdate) AS years,
           strftime(make_date(year(l_shipdate), month(l_shipdate), 1), '%Y-%m-%d') AS month_start
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def fn_date_arith(t):
    joined = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    a, b = F.col("o_orderdate"), F.col("l_shipdate")
    return joined.select(
        "o_orderkey",
        big("l_linenumber").alias("line"),
        day(F.add_months(F.to_date(a), 1)).alias("next_month"),
        day(F.date_add(F.to_date(a), 10)).alias("in_ten_days"),
        big(F.datediff(b, a)).alias("days"),
        big(D.months_crossed(a, b)).alias("months"),
        big(D.years_crossed(a, b)).alias("years"),
        day(F.make_date(F.year(b), F.month(b), F.lit(1))).alias("month_start"),
    )


@query(
    "fn_date_floor",
    oracle="""
    SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day_start,
           strftime(date_trunc('hour', ts + INTERVAL 30 MINUTE), '%Y-%m-%d %H:%M:%S') AS near_hour,
           strftime(date_trunc('day', ts + INTERVAL 12 HOUR), '%Y-%m-%d') AS near_day,
           strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d') AS tomorrow
    FROM events
    """,
)
def fn_date_floor(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        day(F.date_trunc("day", ts)).alias("day_start"),
        second(D.nearest_hour(ts)).alias("near_hour"),
        day(D.nearest_day(ts)).alias("near_day"),
        day(F.date_add(F.to_date(ts), 1)).alias("tomorrow"),
    )


@query(
    "fn_last_weekday",
    oracle="""
    SELECT o_orderkey, strftime(d - CAST((date_diff('day', DATE '2000-01-07', d) % 7 + 7) % 7 AS INTEGER), '%Y-%m-%d') AS on_or_before,
           strftime(d - 1 - CAST((date_diff('day', DATE '2000-01-07', d - 1) % 7 + 7) % 7 AS INTEGER), '%Y-%m-%d') AS before
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    """,
)
def fn_last_weekday(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", day(D.friday_on_or_before(d)).alias("on_or_before"), day(D.friday_before(d)).alias("before")
    )


@query(
    "fn_end_of_year",
    oracle="SELECT o_orderkey, strftime(make_date(year(o_orderdate), 12, 31), '%Y-%m-%d') AS year_end FROM orders",
)
def fn_end_of_year(t):
    return t.orders.select("o_orderkey", day(D.end_of_year(F.col("o_orderdate"))).alias("year_end"))


@query(
    "fn_date_format_parse",
    oracle="""
    SELECT event_id, strftime(ts, '%Y%m%d') AS compact, strftime(ts, '%d.%m.%Y') AS dotted,
           CASE WHEN event_type <> 'error' THEN strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS parsed
    FROM events
    """,
)
def fn_date_format_parse(t):
    compact, dotted = F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "dd.MM.yyyy")
    kind = F.col("event_type")
    written = F.when(kind == "click", compact).when(kind == "error", "Wrong Date").otherwise(dotted)
    return t.events.select(
        "event_id",
        compact.alias("compact"),
        dotted.alias("dotted"),
        day(D.parse_date(written, "yyyyMMdd", "dd.MM.yyyy")).alias("parsed"),
    )


@query(
    "fn_math",
    oracle="""
    SELECT c_custkey, CAST(abs(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS a, CAST(floor(c_acctbal) AS BIGINT) AS f,
           CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS r, c_custkey % 7 AS m, c_custkey // 7 AS d,
           CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(9,0)) AS BIGINT) AS n
    FROM customer
    """,
)
def fn_math(t):
    return t.sql(
        """
        SELECT c_custkey, cast(abs(bal) AS double) AS a, cast(floor(c_acctbal) AS bigint) AS f,
               cast(round(bal, 1) AS double) AS r, c_custkey % 7 AS m, c_custkey div 7 AS d,
               cast(cast(bal AS decimal(9,0)) AS bigint) AS n
        FROM (SELECT *, cast(c_acctbal AS decimal(18,2)) AS bal FROM {customer})
        """
    )


@query(
    "fn_conditional",
    oracle="""
    SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS size,
           nullif(o_orderstatus, 'P') AS status, COALESCE(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') AS first_known
    FROM orders
    """,
)
def fn_conditional(t):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 250000, "large").otherwise("small").alias("size"),
        status.alias("status"),
        F.coalesce(status, F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("none")).alias("first_known"),
    )


@query(
    "fn_cast",
    oracle="""
    SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, CAST(CAST(p_retailprice AS DECIMAL(18,0)) AS BIGINT) AS whole,
           TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_no, TRY_CAST(p_name AS BIGINT) AS not_a_number
    FROM part
    """,
)
def fn_cast(t):
    return t.part.select(
        "p_partkey",
        text("p_size").alias("size_text"),
        big(money("p_retailprice").cast("decimal(18,0)")).alias("whole"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).try_cast("bigint").alias("brand_no"),
        F.col("p_name").try_cast("bigint").alias("not_a_number"),
    )


@query(
    "fn_hash_random",
    oracle="""
    SELECT event_id, md5(event_id || '-7') AS code, sha256(event_type) AS type_code,
           ('0x' || substr(md5(event_id || '-7'), 1, 7))::BIGINT / 268435456.0::DOUBLE AS r FROM events
    """,
)
def fn_hash_random(t):
    """Hashes, and random-looking numbers in [0, 1) from a hash of the key: the same on
    every run and retry, unlike a generator tied to partition order."""
    code = F.md5(F.concat(text("event_id"), F.lit("-7")))
    number = big(F.conv(F.substring(code, 1, 7), 16, 10)) / float(1 << 28)
    return t.events.select("event_id", code.alias("code"), F.sha2("event_type", 256).alias("type_code"), number.alias("r"))


@query(
    "fn_variant",
    oracle="""
    SELECT p_partkey, 'size' AS attribute, 'BIGINT' AS kind, CAST(p_size AS VARCHAR) AS value FROM part
    UNION ALL SELECT p_partkey, 'brand', 'STRING', p_brand FROM part
    UNION ALL SELECT p_partkey, 'since', 'DATE', strftime(DATE '2000-01-01' + p_size, '%Y-%m-%d') FROM part
    """,
)
def fn_variant(t):
    """One column holding whole numbers, text and dates, each keeping its type."""
    pairs = {
        "size": F.col("p_size"),
        "brand": F.col("p_brand"),
        "since": F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")),
    }
    cells = F.array(*[F.struct(F.lit(n).alias("attribute"), x.cast("variant").alias("v")) for n, x in pairs.items()])
    rows = t.part.select("p_partkey", F.inline(cells))
    return rows.select(
        "p_partkey", "attribute", F.schema_of_variant("v").alias("kind"), F.variant_get("v", "$", "string").alias("value")
    )
