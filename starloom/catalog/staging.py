"""Sources: what is written in a format must come back through its reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog.registry import query
from starloom.functions import timestamp_to_epoch_millis
from starloom.schemas import DOUBLE, INT, LONG, STRING, WHOLE_18, struct
from starloom.session import scratch_path
from starloom.sinks import write_csv, write_text
from starloom.sources import (
    conform_types,
    label_mappings,
    read_csv,
    read_json,
    read_json_tree,
    read_landing,
    read_parquet,
    read_whole_text,
    stage_json,
    table,
)

EVENTS = struct(event_id=LONG, user_id=LONG, event_type=STRING, value=DOUBLE, ms=LONG)
ORDERS = struct(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=STRING, o_totalprice=DOUBLE)
# Separates the texts of one file; it does not occur in them.
RECORD = "\x1e"


@query("src_json_glob", """
SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ms FROM events
""")
def src_json_glob(spark, sf):
    """JSON lines two folders down."""
    root = scratch_path(spark, "json-glob")
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", timestamp_to_epoch_millis("ts").alias("ms"),
        F.date_format("ts", "yyyy").alias("y"), F.date_format("ts", "MM").alias("m"),
    )
    events.hint("rebalance", "y", "m").write.partitionBy("y", "m").json(root)
    # The year and month folders are layout, not data.
    return read_json(spark, root, EVENTS, depth=2).select(*EVENTS.names)


@query("src_json_recursive", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def src_json_recursive(spark, sf):
    """JSON lines at any depth; files with another suffix are left alone."""
    root = scratch_path(spark, "json-tree")
    orders = table(spark, sf, "orders").select(*ORDERS.names)
    orders.filter("o_orderstatus = 'F'").write.json(f"{root}/a/finished")
    orders.filter("o_orderstatus <> 'F'").write.json(f"{root}/b/c/open")
    write_text(orders.select("o_orderstatus"), f"{root}/b/notes")
    return read_json_tree(spark, root, ORDERS)


@query("src_json_paths", """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS amount FROM events
""")
def src_json_paths(spark, sf):
    """Positional load: the first path fills the first column."""
    root = scratch_path(spark, "json-paths")
    write_text(table(spark, sf, "events").select("props"), root)
    return stage_json(spark, root, struct(amount=LONG), json_paths=["$.k"])


@query("src_truncate_columns", """
SELECT c_custkey, left(c_name, 10) AS c_name, left(c_mktsegment, 4) AS c_mktsegment FROM customer
""")
def src_truncate_columns(spark, sf):
    """Load by field name with text cut to the declared width."""
    root = scratch_path(spark, "json-widths")
    table(spark, sf, "customer").write.json(root)
    declared = struct(c_custkey=LONG, c_name=STRING, c_mktsegment=STRING)
    return stage_json(spark, root, declared, widths={"c_name": 10, "c_mktsegment": 4})


@query("src_prefix", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def src_prefix(spark, sf):
    """Load of what lies under one prefix; nothing else is listed or read."""
    root = scratch_path(spark, "prefix")
    orders = table(spark, sf, "orders").select(*ORDERS.names)
    orders.hint("rebalance", "o_orderstatus").write.partitionBy("o_orderstatus").json(root)
    under = struct(o_orderkey=LONG, o_custkey=LONG, o_totalprice=DOUBLE)
    return stage_json(spark, f"{root}/o_orderstatus=F", under)


@query("src_typed_staging", """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18, 0)) AS l_extendedprice,
       CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem
""")
def src_typed_staging(spark, sf):
    """Cast to declared types; scale 0 rounds half up."""
    declared = struct(l_orderkey=LONG, l_linenumber=INT, l_extendedprice=WHOLE_18, l_shipdate=STRING)
    return conform_types(table(spark, sf, "lineitem"), declared)


@query("src_csv_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_header(spark, sf):
    root = scratch_path(spark, "csv")
    customer = table(spark, sf, "customer")
    write_csv(customer, root)
    return read_csv(spark, root, customer.schema)


@query("src_csv_semicolon", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_csv_semicolon(spark, sf):
    root = scratch_path(spark, "csv-semicolon")
    supplier = table(spark, sf, "supplier")
    write_csv(supplier, root, sep=";")
    return read_csv(spark, root, supplier.schema, sep=";")


@query("src_csv_multifile", """
SELECT o_orderkey, ' ' || o_orderpriority || ', "' || o_orderstatus || '"' || chr(10) || 'line 2 ' AS note,
       CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'F' THEN chr(13) || chr(10) END AS rest
FROM orders
""")
def src_csv_multifile(spark, sf):
    """Many files with a header each; fields hold separators, quotes, line breaks and outer blanks."""
    root = scratch_path(spark, "csv-files")
    note = F.concat(
        F.lit(" "), "o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"\nline 2 ')
    ).alias("note")
    rest = F.when(F.col("o_orderstatus") == "O", "").when(F.col("o_orderstatus") == "F", "\r\n").alias("rest")
    orders = table(spark, sf, "orders").select("o_orderkey", note, rest)
    write_csv(orders, root, max_records_per_file=4000)
    return read_csv(spark, root, struct(o_orderkey=LONG, note=STRING, rest=STRING))


@query("src_bad_records", """
SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 7 = 0 THEN '{"o_orderkey": ' || o_orderkey || ', "o_ord' END AS _bad_record
FROM orders
""")
def src_bad_records(spark, sf):
    """JSON lines of which every seventh order's is cut off: kept beside the good ones."""
    root = scratch_path(spark, "bad-records")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    cut = F.concat(F.lit('{"o_orderkey": '), F.col("o_orderkey").cast("string"), F.lit(', "o_ord'))
    line = F.when(F.col("o_orderkey") % 7 == 0, cut).otherwise(F.to_json(F.struct(*orders.columns)))
    write_text(orders.select(line.alias("value")), f"{root}/orders.json")
    return stage_json(spark, f"{root}/orders.json", struct(o_orderkey=LONG, o_orderstatus=STRING), mode="keep")


@query("src_json_positions", """
SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS price, o_custkey AS who FROM orders
""")
def src_json_positions(spark, sf):
    """Several columns by their place in a path list, one path two levels deep."""
    root = scratch_path(spark, "json-positions")
    record = F.struct(
        F.struct(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("spent")).alias("buyer"),
        F.col("o_orderstatus").alias("s"), F.col("o_orderkey").alias("k"),
    )
    write_text(table(spark, sf, "orders").select(F.to_json(record).alias("value")), root)
    declared = struct(id=LONG, status=STRING, price=DOUBLE, who=LONG)
    return stage_json(spark, root, declared, ["$.k", "$['s']", "$.buyer.spent", "$.buyer.id"])


@query("src_landing_format", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def src_landing_format(spark, sf):
    """A landing zone in any installed format, named by a parameter."""
    root = scratch_path(spark, "landing")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    lines.write.format("orc").save(root)
    return read_landing(spark, root, "orc", lines.schema)


@query("src_wholetext", "SELECT doc_id, text FROM documents")
def src_wholetext(spark, sf):
    """Whole files as single values, split back into the texts they were made of.

    The number of texts per file is bounded when writing, not the length of a text.
    """
    root = scratch_path(spark, "wholetext")
    record = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), F.col("text"))
    write_text(table(spark, sf, "documents").select(record.alias("value")), root, RECORD, 2000)
    records = read_whole_text(spark, root).select(
        F.explode(F.split("value", RECORD)).alias("record")
    ).filter("record <> ''")
    tab = F.locate("\t", "record")
    return records.select(
        F.expr("substring(record, 1, locate('\t', record) - 1)").cast("bigint").alias("doc_id"),
        F.col("record").substr(tab + 1, F.length("record")).alias("text"),
    )


@query("src_parquet", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def src_parquet(spark, sf):
    columns = struct(l_orderkey=LONG, l_partkey=LONG, l_extendedprice=DOUBLE)
    return read_parquet(spark, f"{sf}/lineitem.parquet", columns)


@query("src_table_scan", """
SELECT o_orderstatus, count(*) AS n, CAST(max(o_orderkey) AS BIGINT) AS top_key
FROM orders GROUP BY o_orderstatus
""")
def src_table_scan(spark, sf):
    """SQL over a staging table."""
    return spark.sql("""
        SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS top_key
        FROM {staging_orders} GROUP BY o_orderstatus
    """, staging_orders=table(spark, sf, "orders"))


@query("src_label_mappings", """
SELECT 'i94custl' AS mapping, CAST(c_custkey AS VARCHAR) AS code, c_name AS label FROM customer
UNION ALL
SELECT 'I94SEGM', 'C-' || CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer
""")
def src_label_mappings(spark, sf):
    """Label documents with bare and quoted codes and labels, read as whole files."""
    root = scratch_path(spark, "labels")
    key = F.col("c_custkey").cast("string")
    paragraphs = F.concat(
        F.lit("/* customers by number */\n  value i94custl\n\t"), key,
        F.lit("  =  '"), F.col("c_name"), F.lit("'\n;\n/* no pairs here */\n value $I94SEGM\n 'C-"),
        key, F.lit("'\t= "), F.col("c_mktsegment"), F.lit("\n;"),
    )
    write_text(table(spark, sf, "customer").select(paragraphs.alias("value")), root, "\n", 5000)
    return label_mappings(spark, root)
