"""Table changes. Stored orders are those whose priority is not 5-LOW; the change
set holds the missing ones (new) and the finished ones (changed)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big, day, money, ntz, real, second
from millrace.operators import changes as M
from millrace.operators import quality as Q
from millrace.registry import query
from millrace.sources.documents import order_lines
from millrace.sources.tables import work_path

COLUMNS = ["o_orderkey", "o_orderstatus", "price", "version"]
LOW, FINISHED, LARGE = "o_orderpriority = '5-LOW'", "o_orderstatus = 'F'", "o_totalprice > 300000"
VERSION = "CAST(year(o_orderdate) AS BIGINT)"


def stored(t):
    return t.orders.where(~F.expr(LOW)).select(
        "o_orderkey", "o_orderstatus", money("o_totalprice").alias("price"), big(F.year("o_orderdate")).alias("version")
    )


def incoming(t):
    """New and changed rows; large orders carry an outdated version."""
    stale = F.when(F.expr(LARGE), 1).otherwise(0)
    return t.orders.where(F.expr(LOW) | F.expr(FINISHED)).select(
        "o_orderkey",
        F.lit("N").alias("o_orderstatus"),
        (money("o_totalprice") + 100).cast("decimal(18,2)").alias("price"),
        (big(F.year("o_orderdate")) - stale).alias("version"),
    )


def _shown(df):
    return df.withColumn("price", real("price"))


@query(
    "update_where",
    oracle=f"""
    SELECT o_orderkey, CASE WHEN {LARGE} THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN {LARGE} THEN '2002-01-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS modified
    FROM orders
    """,
)
def update_where(t):
    o = t.orders.withColumn("modified", F.col("o_orderdate"))
    done = M.update_where(o, F.expr(LARGE), o_orderstatus=F.lit("X"), modified=ntz("2002-01-01"))
    return done.select("o_orderkey", "o_orderstatus", day("modified").alias("modified"))


@query(
    "delete_where",
    oracle="""
    SELECT o_orderkey FROM orders WHERE NOT COALESCE(nullif(o_orderstatus, 'P') = 'F' AND o_totalprice > 100000, FALSE)
    """,
)
def delete_where(t):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return M.delete_where(t.orders, (status == "F") & (F.col("o_totalprice") > 100000)).select("o_orderkey")


@query(
    "update_from_join",
    oracle="""
    SELECT s_suppkey, COALESCE(CAST(q AS DOUBLE), s_acctbal) AS s_acctbal FROM supplier LEFT JOIN
      (SELECT l_suppkey, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
      ON l_suppkey = s_suppkey AND s_nationkey < 10
    """,
)
def update_from_join(t):
    """The joined side is grouped first: one value per target row."""
    sums = t.lineitem.where(F.col("l_returnflag") == "R").groupBy("l_suppkey").agg(real(F.sum(money("l_quantity"))).alias("q"))
    on = (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("s_nationkey") < 10)
    return t.supplier.join(sums, on, "left").select("s_suppkey", F.coalesce("q", "s_acctbal").alias("s_acctbal"))


@query(
    "merge_upsert",
    oracle=f"""
    SELECT o_orderkey,
      CASE WHEN {LOW} THEN 'insert' WHEN {FINISHED} AND NOT {LARGE} THEN 'update' WHEN {FINISHED} THEN 'conflict' ELSE 'keep' END AS action,
      CASE WHEN {LOW} OR ({FINISHED} AND NOT {LARGE}) THEN 'N' ELSE o_orderstatus END AS o_orderstatus,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN {LOW} OR ({FINISHED} AND NOT {LARGE}) THEN 100 ELSE 0 END AS DOUBLE) AS price,
      {VERSION} - CASE WHEN {LOW} AND {LARGE} THEN 1 ELSE 0 END AS version
    FROM orders
    """,
)
def merge_upsert(t):
    """Every row of the new state with what happened to it."""
    return _shown(M.upsert(stored(t), incoming(t), ["o_orderkey"], "version"))


@query(
    "merge_flags",
    oracle="""
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS DOUBLE) AS price
    FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority = '5-LOW'
    """,
)
def merge_flags(t):
    """5-LOW orders are new, open ones change, finished ones go."""
    changes = t.orders.select(
        "o_orderkey",
        (money("o_totalprice") + F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).cast("decimal(18,2)").alias("price"),
        (F.expr(LOW)).alias("is_new"),
        (F.col("o_orderstatus") == "O").alias("is_dirty"),
        (F.expr(FINISHED) & ~F.expr(LOW)).alias("is_deleted"),
    )
    target = stored(t).select("o_orderkey", "price")
    done = M.apply_flags(
        target, changes, ["o_orderkey"], ["price"],
        insert=F.col("is_new"), update=~F.col("is_new") & F.col("is_dirty"), delete=F.col("is_deleted"),
    )
    return _shown(done)


def movements(t):
    """events as stock movements: purchases take out, the others bring in."""
    sign = F.when(F.col("event_type") == "purchase", -1).otherwise(1)
    return t.events.select(
        F.col("user_id").alias("item"), F.col("ts").alias("moved"), (sign * big(F.round("value"))).alias("quantity"), "event_type", "event_id"
    )


MOVES = """
SELECT user_id AS item, ts AS moved, event_type, event_id,
       CASE WHEN event_type = 'purchase' THEN -1 ELSE 1 END * CAST(round(value) AS BIGINT) AS quantity FROM events
"""


@query(
    "merge_by_source",
    oracle=f"""
    WITH m AS (SELECT item, moved, CASE WHEN event_type = 'click' THEN quantity + 5 ELSE quantity END AS quantity
               FROM ({MOVES}) WHERE event_type <> 'error')
    SELECT item, strftime(moved, '%Y-%m-%d %H:%M:%S.%f') AS moved, quantity, CAST(SUM(quantity) OVER w AS BIGINT) AS current_quantity,
           CAST(SUM(quantity) OVER (PARTITION BY item ORDER BY moved ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS previous_quantity,
           strftime(lag(moved) OVER w, '%Y-%m-%d %H:%M:%S.%f') AS previous_date
    FROM (SELECT * FROM m WHERE quantity <> 0) WINDOW w AS (PARTITION BY item ORDER BY moved)
    """,
)
def merge_by_source(t):
    """The log lacks sign-ups. Changes insert them, replace clicks (+5) and remove
    errors (quantity 0); later balances move accordingly, from the stored ones."""
    moves = movements(t).where(F.col("quantity") != 0)
    kind = F.col("event_type")
    log = moves.where(kind != "signup").select("item", "moved", "quantity")
    new_quantity = F.when(kind == "click", F.col("quantity") + 5).when(kind == "error", 0).otherwise(F.col("quantity"))
    zero_clicks = movements(t).where((F.col("quantity") == 0) & (kind == "click"))
    changes = moves.where(kind.isin("signup", "click", "error")).unionByName(zero_clicks)
    changes = changes.select("item", "moved", new_quantity.alias("quantity"))
    names = ("item", "moved", "quantity")
    done = M.rebuild_history(M.chain_history(log, *names), changes, *names)
    stamp = lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return done.select(
        "item", stamp("moved").alias("moved"), "quantity", "current_quantity", "previous_quantity", stamp("previous_date").alias("previous_date")
    )


@query(
    "guarded_insert",
    oracle=f"""
    WITH s AS (SELECT item, SUM(quantity) AS stock, MAX(moved) AS last FROM ({MOVES}) GROUP BY item)
    , a AS (SELECT c_custkey AS item, COALESCE(stock, 0) AS s0, last, CASE WHEN COALESCE(stock, 0) >= 3000 AND COALESCE(last < TIMESTAMP '2024-01-30 12:00:00', TRUE) THEN 1 ELSE 0 END AS t1
            FROM customer LEFT JOIN s ON item = c_custkey),
    b AS (SELECT *, CASE WHEN s0 - 3000 * t1 >= 2500 AND COALESCE(last < TIMESTAMP '2024-01-30 18:00:00', TRUE) THEN 1 ELSE 0 END AS t2 FROM a),
    c AS (SELECT *, CASE WHEN t2 = 0 AND s0 - 3000 * t1 >= 1000 AND COALESCE(last < TIMESTAMP '2024-01-30 18:00:00', TRUE) THEN 1 ELSE 0 END AS t3 FROM b),
    d AS (SELECT *, CASE WHEN COALESCE(last < TIMESTAMP '2024-02-01', TRUE) THEN 1 ELSE 0 END AS t4 FROM c),
    e AS (SELECT *, CASE WHEN s0 - 3000 * t1 - 2500 * t2 - 1000 * t3 + 700 * t4 >= 600 AND COALESCE(last < TIMESTAMP '2024-02-02', TRUE) THEN 1 ELSE 0 END AS t5 FROM d)
    SELECT item, CAST(n AS BIGINT) AS n, CAST(accepted AS BIGINT) AS accepted
    FROM (SELECT item, unnest([1, 2, 3, 4, 5]) AS n, unnest([t1, t2, t3, t4, t5]) AS accepted FROM e)
    """,
)
def guarded_insert(t):
    """Withdrawals are tried one after the other on every customer's stock: two of them at
    one time, of which at most one can be entered, and a delivery before the last."""
    tries = [
        ("2024-01-30 12:00:00", -3000), ("2024-01-30 18:00:00", -2500), ("2024-01-30 18:00:00", -1000),
        ("2024-02-01 00:00:00", 700), ("2024-02-02 00:00:00", -600),
    ]
    rows = [
        F.struct(F.lit(n).alias("n"), ntz(at).alias("moved"), F.lit(moved).cast("bigint").alias("quantity"))
        for n, (at, moved) in enumerate(tries, 1)
    ]
    wanted = t.customer.select(F.col("c_custkey").alias("item"), F.inline(F.array(*rows)))
    tried = M.guard_inserts(movements(t), wanted, "item", "moved", "quantity", ["n"])
    return tried.select("item", big("n").alias("n"), big("accepted").alias("accepted"))


@query(
    "single_row_update_guard",
    oracle="SELECT s_suppkey, CASE WHEN s_name = 'Supplier#000000007' THEN 0.0 ELSE s_acctbal END AS s_acctbal FROM supplier",
)
def single_row_update_guard(t):
    s = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    done = M.update_single_row(s, F.col("s_name") == "Supplier#000000007", s_acctbal=F.lit(0.0))
    return done.select("s_suppkey", "s_acctbal")


@query(
    "change_log",
    oracle=f"""
    SELECT o_orderkey, 'o_orderstatus' AS "column", o_orderstatus AS old_value, 'N' AS new_value FROM orders WHERE {FINISHED} AND NOT {LOW}
    UNION ALL
    SELECT o_orderkey, 'version', CAST({VERSION} AS VARCHAR), CAST({VERSION} - 1 AS VARCHAR) FROM orders WHERE {FINISHED} AND NOT {LOW} AND {LARGE}
    """,
)
def change_log(t):
    return M.change_log(stored(t), incoming(t), ["o_orderkey"], ["o_orderstatus", "version"])


@query(
    "audit_inserts",
    oracle=f"SELECT o_orderkey, 'INSERT' AS audit_action, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS audit_at FROM orders WHERE {LOW}",
)
def audit_inserts(t):
    inserted = t.orders.where(F.expr(LOW))
    return M.audit_rows(inserted, ["o_orderkey"], second("o_orderdate"))


@query(
    "soft_delete",
    oracle="""
    SELECT 'customer' AS tab, c_custkey AS id, CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS deleted FROM customer
    UNION ALL
    SELECT 'orders', o_orderkey, CAST(CASE WHEN c_acctbal < 0 OR o_orderstatus = 'P' THEN 1 ELSE 0 END AS BIGINT) FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def soft_delete(t):
    """Customers with a negative balance go, their orders with them; pending orders
    were marked before."""
    parents = t.customer.withColumn("deleted", F.lit(False))
    children = t.orders.withColumn("deleted", F.col("o_orderstatus") == "P")
    p, c = M.soft_delete(parents, children, "c_custkey", "o_custkey", F.col("c_acctbal") < 0, "deleted")
    show = lambda df, tab, key: df.select(F.lit(tab).alias("tab"), F.col(key).alias("id"), big("deleted").alias("deleted"))
    return show(p, "customer", "c_custkey").unionByName(show(c, "orders", "o_orderkey"))


@query(
    "cascade_update",
    oracle="""
    SELECT o_orderkey, CASE WHEN c_mktsegment = 'BUILDING' THEN o_custkey + 1000000 ELSE o_custkey END AS o_custkey
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def cascade_update(t):
    moved = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    renamed = moved.select("c_custkey", (F.col("c_custkey") + 1000000).alias("new_key"))
    return M.cascade_key(t.orders, "o_custkey", renamed, "c_custkey", "new_key").select("o_orderkey", "o_custkey")


@query(
    "order_insert_with_details",
    oracle="""
    SELECT o_orderkey AS orderid, o_custkey, CAST(COALESCE(total, 0) AS DOUBLE) AS total, COALESCE(n, 0) AS n_details FROM orders
    LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total, COUNT(*) AS n FROM lineitem GROUP BY 1)
      ON l_orderkey = o_orderkey
    """,
)
def order_insert_with_details(t):
    """Headers and details are appended to two tables and read back together."""
    headers_path, details_path = work_path(t.spark, "headers"), work_path(t.spark, "details")
    details = order_lines(t.lineitem)
    headers = t.orders.select(F.col("o_orderkey").alias("orderid"), "o_custkey")
    details.write.mode("append").parquet(details_path)
    kept = t.spark.read.parquet(details_path)
    M.headers_from_details(headers, kept, "orderid", F.col("total"), "total").write.mode("append").parquet(headers_path)
    counts = kept.groupBy("orderid").agg(F.count(F.lit(1)).alias("n"))
    read = t.spark.read.parquet(headers_path).join(counts, "orderid", "left")
    return read.select("orderid", "o_custkey", real("total").alias("total"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_details"))


@query(
    "update_swap",
    oracle="""
    SELECT c_custkey, CASE c_name WHEN 'Customer#000000001' THEN 'Customer#000000002' WHEN 'Customer#000000002' THEN 'Customer#000000001' ELSE c_name END AS c_name
    FROM customer
    """,
)
def update_swap(t):
    """After the swap no name may occur twice."""
    done = M.swap_values(t.customer.select("c_custkey", "c_name"), "c_name", "Customer#000000001", "Customer#000000002")
    if not Q.duplicate_keys(done, ["c_name"]).isEmpty():
        raise ValueError("duplicate names after the swap")
    return done
