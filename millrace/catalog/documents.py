"""JSON, XML and text on columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.common import big, money, real, text
from millrace.catalog.sources import ORDER_LINES_SQL
from millrace.functions import json as X
from millrace.operators import changes as M
from millrace.operators.text_index import build_index, search_index
from millrace.registry import query
from millrace.sources.documents import order_json, order_lines, order_xml, parse_order_xml
from millrace.sources.tables import work_path

ITEMS_SCHEMA = "array<struct<line: bigint, item: struct<id: bigint, qty: bigint>>>"
LINES = f"SELECT orderid, linenumber AS line, productid AS id, CAST(qty AS BIGINT) AS qty FROM ({ORDER_LINES_SQL})"


def docs(t):
    return order_json(order_lines(t.lineitem))


def items(t):
    """Documents exploded back to typed rows."""
    rows = docs(t).select("orderid", F.inline(F.from_json("items", ITEMS_SCHEMA)))
    return rows.select("orderid", "line", F.col("item.id").alias("id"), F.col("item.qty").alias("qty"))


@query(
    "json_value",
    oracle="""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing
    FROM events
    """,
)
def json_value(t):
    return t.events.select(
        "event_id",
        big(F.get_json_object("props", "$.k")).alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )


@query(
    "json_query",
    oracle=f"""
    SELECT orderid, '{{"id":' || arg_min(id, line) || ',"qty":' || arg_min(qty, line) || '}}' AS first_item FROM ({LINES}) GROUP BY orderid
    """,
)
def json_query(t):
    return docs(t).select("orderid", F.get_json_object("items", "$[0].item").alias("first_item"))


@query(
    "json_is_valid",
    oracle="""
    SELECT event_id, CAST(CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 0 ELSE 1 END AS BIGINT) AS valid FROM events
    """,
)
def json_is_valid(t):
    kind = F.col("event_type")
    doc = F.when(kind == "error", F.concat(F.lit("{broken "), "props")).when(kind == "purchase", text("event_id")).otherwise(F.col("props"))
    return t.events.select("event_id", X.is_json(doc).alias("valid"))


@query(
    "json_modify",
    oracle="""
    SELECT event_id, '{"info":{"name":"' || event_type || '","address":{"zip":1.5,"town":"' || event_type || '-town"}},"k":' ||
      (CAST(json_extract_string(props, '$.k') AS BIGINT) + 1000) || ',"tags":[1,' ||
      CASE WHEN event_type = 'click' THEN 'null' ELSE '"' || event_type || '"' END || ']}' AS props FROM events
    """,
)
def json_modify(t):
    """A number at the top, a text further down and an element of an array, which clicks
    set to null, are changed; the other members stay."""
    k = F.get_json_object("props", "$.k")
    name = F.concat(F.lit('{"info":{"name":"'), "event_type", F.lit('","address":{"zip":1.5}},"k":'), k, F.lit(',"tags":[1,2]}'))
    town = F.concat("event_type", F.lit("-town"))
    done = X.set_value(X.set_value(name, "$.k", big(k) + 1000), "$.info.address.town", town)
    rows = t.events.select("event_id", "event_type", done.alias("props"))
    tag = F.when(F.col("event_type") != "click", F.col("event_type"))
    return rows.select("event_id", X.set_value(F.col("props"), "$.tags[1]", tag).alias("props"))


@query("json_explode_typed", oracle=LINES)
def json_explode_typed(t):
    return items(t)


def line_arrays(t):
    """Orders with their line numbers as a JSON array of scalars."""
    return order_lines(t.lineitem).groupBy("orderid").agg(
        F.to_json(F.array_sort(F.collect_list("linenumber"))).alias("lines")
    )


@query("json_explode_scalars", oracle=f"SELECT line, COUNT(*) AS n_orders FROM ({LINES}) GROUP BY line")
def json_explode_scalars(t):
    values = line_arrays(t).select(F.explode(F.from_json("lines", "array<bigint>")).alias("line"))
    return values.groupBy("line").agg(F.count(F.lit(1)).alias("n_orders"))


@query("json_strict_path", oracle="SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_strict_path(t):
    return t.events.select("event_id", big(X.strict_value(F.col("props"), "$.k")).alias("k"))


@query(
    "json_build_nested",
    oracle="""
    SELECT c_custkey, '{"id":' || c_custkey || ',"info":{"name":"' || c_name || '"' ||
      CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END || '}}' AS doc
    FROM customer
    """,
)
def json_build_nested(t):
    """NULL cells are left out of the object."""
    info = F.struct(F.col("c_name").alias("name"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    doc = F.to_json(F.struct(F.col("c_custkey").alias("id"), info.alias("info")))
    return t.customer.select("c_custkey", doc.alias("doc"))


@query(
    "json_build_auto",
    oracle=f"""
    SELECT o_orderkey, '{{"order":' || o_orderkey || ',"status":"' || o_orderstatus || '","lines":[' ||
      string_agg('{{"line":' || line || ',"part":' || id || '}}', ',' ORDER BY line) || ']}}' AS doc
    FROM orders JOIN ({LINES}) ON orderid = o_orderkey GROUP BY o_orderkey, o_orderstatus
    """,
)
def json_build_auto(t):
    """Nesting follows the join: the parent row holds its child rows."""
    child = F.struct(F.col("linenumber").alias("line"), F.col("productid").alias("part"))
    children = order_lines(t.lineitem).groupBy("orderid").agg(F.array_sort(F.collect_list(child)).alias("lines"))
    joined = t.orders.join(children, F.col("orderid") == F.col("o_orderkey"))
    doc = F.struct(F.col("o_orderkey").alias("order"), F.col("o_orderstatus").alias("status"), "lines")
    return joined.select("o_orderkey", F.to_json(doc).alias("doc"))


@query(
    "json_raw_array",
    oracle=f"SELECT orderid, '[' || string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) || ']' AS lines FROM ({LINES}) GROUP BY orderid",
)
def json_raw_array(t):
    return line_arrays(t)


@query(
    "json_denormalize",
    oracle=f"""
    SELECT o_orderkey, items, lines FROM orders
    LEFT JOIN (SELECT orderid, '[' || string_agg('{{"line":' || line || ',"item":{{"id":' || id || ',"qty":' || qty || '}}}}', ',' ORDER BY line) || ']' AS items,
                 '[' || string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) || ']' AS lines FROM ({LINES}) GROUP BY orderid)
      ON orderid = o_orderkey
    """,
)
def json_denormalize(t):
    """Both child arrays come from one grouping of the child table."""
    item = F.struct(
        F.col("linenumber").alias("line"),
        F.struct(F.col("productid").alias("id"), big("qty").alias("qty")).alias("item"),
    )
    folded = order_lines(t.lineitem).groupBy("orderid").agg(
        F.to_json(F.array_sort(F.collect_list(item))).alias("items"),
        F.to_json(F.array_sort(F.collect_list("linenumber"))).alias("lines"),
    )
    joined = t.orders.join(folded, F.col("orderid") == F.col("o_orderkey"), "left")
    return joined.select("o_orderkey", "items", "lines")


@query(
    "json_group_report",
    oracle="""
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 20 GROUP BY 1 HAVING COUNT(*) > 90
    """,
)
def json_group_report(t):
    rows = t.events.select(big(F.get_json_object("props", "$.k")).alias("k"), "value")
    sums = rows.where(F.col("k") >= 20).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), real(F.sum(money("value"))).alias("total")
    )
    return sums.where(F.col("n") > 90)


@query(
    "json_filter_by_element",
    oracle=f"SELECT DISTINCT orderid FROM ({LINES}) WHERE qty >= 50 OR (line = 7 AND qty < 5)",
)
def json_filter_by_element(t):
    """Orders whose array holds a large item, or a small item on line 7."""
    wanted = lambda x: (x["item"]["qty"] >= 50) | ((x["line"] == 7) & (x["item"]["qty"] < 5))
    return docs(t).where(F.exists(F.from_json("items", ITEMS_SCHEMA), wanted)).select("orderid")


@query(
    "json_upsert",
    oracle="""
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'VIP' ELSE c_mktsegment END AS segment FROM customer WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL
    SELECT c_custkey, 'VIP' FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 5000
    """,
)
def json_upsert(t):
    """Documents name customers; known ones are updated, unknown ones inserted."""
    doc = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.lit("VIP").alias("segment")))
    documents = t.customer.where(F.col("c_acctbal") > 5000).select(doc.alias("doc"))
    parsed = documents.select(F.from_json("doc", "id bigint, segment string").alias("d"))
    source = parsed.select(F.col("d.id").alias("c_custkey"), "d.segment")
    target = t.customer.where(F.col("c_mktsegment") != "MACHINERY").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return M.new_state(M.upsert(target, source, ["c_custkey"]), target.columns)


@query(
    "json_computed_column",
    oracle="""
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 40 AND 60
    """,
)
def json_computed_column(t):
    """The path is written as a column; filters on it then reach the scan."""
    path = work_path(t.spark, "computed-column")
    t.events.withColumn("k", big(F.get_json_object("props", "$.k"))).write.parquet(path)
    return t.spark.read.parquet(path).where(F.col("k").between(40, 60)).select("event_id", "event_type", "k")


@query(
    "text_contains_terms",
    oracle=r"""
    WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{L}]+') AS w FROM documents)
    SELECT 'one' AS search, doc_id FROM w WHERE list_contains(w, 'than')
    UNION ALL SELECT 'either', doc_id FROM w WHERE list_contains(w, 'than') OR list_contains(w, 'eaux')
    """,
)
def text_contains_terms(t):
    """One index answers both searches; the texts are read once, when it is built."""
    path = work_path(t.spark, "text-index")
    build_index(t.documents, "doc_id", "text", path)
    found = search_index(t.spark, path, {"one": [["than"]], "either": [["than", "eaux"]]})
    return found.select("search", F.col("id").alias("doc_id"))


def event_xml(t):
    """events as XML payloads."""
    body = F.concat(
        F.lit('<event name="'), "event_type",
        F.lit('" timestamp="'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit('"><data name="user"><value>'), text("user_id"),
        F.lit('</value></data><data name="amount"><value>'), text(money("value")),
        F.lit("</value></data></event>"),
    )
    return t.events.select("event_id", body.alias("doc"))


@query(
    "xml_attribute_shred",
    oracle="""
    SELECT event_id, event_type AS name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, user_id, value AS amount FROM events
    """,
)
def xml_attribute_shred(t):
    schema = "_name string, _timestamp string, data array<struct<_name: string, value: string>>"
    parsed = event_xml(t).select("event_id", F.from_xml("doc", schema).alias("x"))
    pick = lambda name: F.filter("x.data", lambda d: d["_name"] == name)[0]["value"]
    return parsed.select(
        "event_id",
        F.col("x._name").alias("name"),
        F.col("x._timestamp").alias("at"),
        big(pick("user")).alias("user_id"),
        real(pick("amount")).alias("amount"),
    )


@query(
    "xml_rowset_apply_changes",
    oracle=f"""
    SELECT orderid, linenumber, CASE WHEN mark = 'A' THEN productid ELSE productid + 1 END AS productid
    FROM ({ORDER_LINES_SQL}) WHERE mark <> 'R'
    """,
)
def xml_rowset_apply_changes(t):
    """The stored lines lack those marked new and carry an old product number
    where the document marks a change."""
    lines = order_lines(t.lineitem)
    changed = F.col("mark") == "N"
    revised = lines.withColumn("productid", F.col("productid") + F.when(changed, 1).otherwise(0))
    stored = lines.where(F.col("mark") != "A").select("orderid", "linenumber", "productid")
    details = parse_order_xml(order_xml(revised))
    on = lambda flag: F.col(flag) == "-1"
    return M.apply_flags(
        stored, details, ["orderid", "linenumber"], ["productid"],
        insert=on("is_new") & on("is_dirty"), update=~on("is_new") & on("is_dirty"), delete=on("is_deleted"),
    )
