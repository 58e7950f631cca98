"""Registered queries that write given tables to the shared folder and read them back by the scans, loads and streams."""

from __future__ import annotations

import math
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from brindle.functions import columns as c
from brindle.functions.calendar import holidays
from brindle.operators import checks, exports, loads, shaping, stored
from brindle.plans import models
from brindle.plans.queries import AS_OF, HOLIDAYS, ORACLES, query, raw_orders
from brindle.sources import generated, inferred, ledger, scans
from brindle.sources.scans import source
from brindle.sources.scratch import scratch_folder
from brindle.streaming.arrivals import file_stream, into, poll_files, process_files, read_log

#: Rows of a large file.
FILE_ROWS = 2_000_000
CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_lines_landing(spark, sf_dir):
    path = scratch_folder(spark, "customers")
    source(spark, sf_dir, "customer").write.json(path)
    return scans.read_json_landing(spark, path, CUSTOMER, array=False).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def json_array_landing(spark, sf_dir):
    """A file with an array for each nation and range of keys, so that no array grows with the table."""
    path = scratch_folder(spark, "customers")
    some = source(spark, sf_dir, "customer").withColumn("lot", F.floor(F.col("c_custkey") / 10_000))
    arrays = some.groupBy("c_nationkey", "lot").agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name"))).alias("value"))
    arrays.write.partitionBy("c_nationkey", "lot").text(path)  # a row for each folder
    return scans.read_json_landing(spark, path, "c_custkey long, c_name string, c_nationkey int").select("c_custkey", "c_name", "c_nationkey")


@query("SELECT 'nation' AS resource, count(*) AS rows FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'per_segment', count(DISTINCT c_mktsegment) FROM customer")
def multi_resource_load(spark, sf_dir):
    """Two landed resources and a made one, loaded twice over: a replacing load leaves one copy."""
    folder, placed = scratch_folder(spark, "landing"), scratch_folder(spark, "raw")
    for name in ("nation", "region"):
        source(spark, sf_dir, name).write.json(f"{folder}/{name}")
    resources = {n: scans.read_json_landing(spark, f"{folder}/{n}", source(spark, sf_dir, n).schema, array=False) for n in ("nation", "region")}
    resources |= scans.make_resources(spark, {"per_segment": lambda s: source(s, sf_dir, "customer").groupBy("c_mktsegment").count()})
    for _ in range(2):
        where = loads.load(resources, placed)
    counts = [spark.read.parquet(path).agg(F.lit(name).alias("resource"), F.count(F.lit(1)).alias("rows")) for name, path in where.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("WITH " + HOLIDAYS + "SELECT date_key, holiday FROM r")
def holiday_seed(spark, sf_dir):
    """The calendar of the orders' years as a seed file with a header."""
    path = scratch_folder(spark, "seed")
    exports.export_one(holidays(models.calendar_of(source(spark, sf_dir, "orders"), "o_orderdate")), path)
    return scans.read_seed(spark, path, "date_key date, holiday string")


@query("SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey")
def table_family(spark, sf_dir):
    nation, region = scans.register_tables(spark, sf_dir, "geo", ["nation", "region"])
    return spark.sql(f"SELECT n_name, r_name FROM {nation} JOIN {region} ON r_regionkey = n_regionkey")


@query("SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def imported_orders(spark, sf_dir):
    scans.import_as(source(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), "finished_orders")
    return spark.sql("SELECT o_orderpriority, count(*) AS orders FROM finished_orders GROUP BY 1")


@query("SELECT * FROM orders WHERE o_totalprice < 100000")
def replaced_table(spark, sf_dir):
    """A table that is replaced by what is read from it."""
    path = scratch_folder(spark, "orders")
    loads.write_replaced(source(spark, sf_dir, "orders"), path)
    loads.write_replaced(spark.read.parquet(path).where("o_totalprice < 100000"), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders")
def appended_with_new_column(spark, sf_dir):
    """The second batch brings a column that the first has not."""
    path, orders = scratch_folder(spark, "orders"), source(spark, sf_dir, "orders")
    loads.write_appended(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), path)
    loads.write_appended(orders.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").cast("decimal(20,0)").alias("o_orderkey"), "o_totalprice", "o_orderpriority"), path)
    return loads.read_evolved(spark, path).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    """SELECT c_custkey, c_acctbal, NULL::VARCHAR AS tier FROM customer WHERE c_acctbal <= 0
UNION ALL SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal > 5000 THEN 'high' ELSE 'low' END FROM customer WHERE c_acctbal > 0"""
)
def upsert_with_new_column(spark, sf_dir):
    customers = source(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    batch = customers.where("c_acctbal > 0").withColumn("tier", F.when(F.col("c_acctbal") > 5000, "high").otherwise("low"))
    return loads.upsert(customers, batch, ["c_custkey"], [F.desc("c_acctbal")])


@query("SELECT event_type, count(*) AS events, sum(value) AS total FROM events GROUP BY 1")
def rerun_partitions(spark, sf_dir):
    """A run written again replaces its own partition alone."""
    path, events = scratch_folder(spark, "events"), source(spark, sf_dir, "events").select("event_id", "event_type", "value")
    loads.write_run(events.withColumn("value", F.when(F.col("event_type") == "click", 0.0).otherwise(F.col("value"))), path, "event_type")
    loads.write_run(events.where("event_type = 'click'"), path, "event_type")
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 6).alias("total"))


@query("SELECT s.o_orderstatus AS status, s.orders, s.orders = t.orders AS same FROM (SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1) s JOIN (SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1) t USING (o_orderstatus)")
def view_and_table(spark, sf_dir):
    """One model as a view and as a table."""
    model = source(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    view = loads.materialize_view(model, "orders_by_status")
    table = loads.materialize_table(model, f"orders_by_status_{uuid.uuid4().hex[:12]}", scratch_folder(spark, "orders_by_status")).select(F.col("status").alias("_status"), F.col("orders").alias("_orders"))
    return view.join(table, F.col("status") == F.col("_status")).select("status", "orders", (F.col("orders") == F.col("_orders")).alias("same"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def single_export(spark, sf_dir):
    path = scratch_folder(spark, "customers")
    exports.export_one(source(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, sep="|")
    return spark.read.option("header", True).option("sep", "|").schema("c_custkey long, c_name string, c_mktsegment string").csv(path)


@query("SELECT p_name AS value FROM part")
def text_export(spark, sf_dir):
    path = scratch_folder(spark, "parts")
    exports.export_text(source(spark, sf_dir, "part").select("p_name"), path)
    return spark.read.text(path)


@query("SELECT 'segment_' || lower(c_mktsegment) || '.csv' AS file, count(*) AS rows FROM customer GROUP BY 1")
def written_groups(spark, sf_dir):
    """The manifest of a grouped export, of the files as written."""
    path = scratch_folder(spark, "segments")
    exports.export_groups(exports.with_file(source(spark, sf_dir, "customer"), "c_mktsegment", "segment_{c_mktsegment}", {"c_mktsegment": F.lower}), path, salt=3)
    return exports.written_manifest(spark, path).groupBy("file").agg(F.sum("rows").alias("rows"))


@query(
    """SELECT lower(c_mktsegment) || '_20240101.csv' AS file, c_custkey, c_name, c_mktsegment, c_acctbal, true AS one_file FROM customer
WHERE c_mktsegment IS NOT NULL"""
)
def exported_files(spark, sf_dir):
    """Customers in a file for each segment, exported over an export by nation, read back from the files."""
    path, customers = scratch_folder(spark, "customers"), source(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    exports.export_files(exports.with_file(customers, "c_nationkey"), path)
    named = exports.with_file(customers.drop("c_nationkey"), "c_mktsegment", "{c_mktsegment}", {"c_mktsegment": F.lower}, datetime(2024, 1, 1))
    told = exports.export_files(named, path, salt=3).select(F.col("file").alias("_told"))
    back = spark.read.option("header", True).schema("c_custkey long, c_name string, c_mktsegment string, c_acctbal double").csv(path).withColumn("file", F.col("_metadata.file_name"))
    return back.join(told, F.col("file") == F.col("_told"), "left").select("file", "c_custkey", "c_name", "c_mktsegment", "c_acctbal", F.col("_told").isNotNull().alias("one_file"))


@query("SELECT 'nation=' || n_nationkey AS folder FROM nation WHERE n_nationkey >= 5")
def new_files(spark, sf_dir):
    """A listing of written files, from where an earlier listing ended."""
    path, nation = scratch_folder(spark, "nations"), source(spark, sf_dir, "nation").withColumn("nation", F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    nation.where("n_nationkey < 5").repartition("nation").write.partitionBy("nation").csv(path)
    cursor = scans.next_cursor(scans.new_files(spark, path))
    nation.where("n_nationkey >= 5").repartition("nation").write.mode("append").partitionBy("nation").csv(path)
    number = F.regexp_extract("key", r"nation=(\d+)/", 1).cast("int").cast("string")
    return scans.new_files(spark, path, cursor).select(F.concat(F.lit("nation="), number).alias("folder")).distinct()


@query("SELECT max(ts) AS first_state, max(ts) FILTER (WHERE ts <= TIMESTAMP '2024-01-10 00:00:00') AS state_before FROM events")
def cursor_state(spark, sf_dir):
    """The greatest value as state, carried over an extract without rows."""
    events = source(spark, sf_dir, "events")
    before = loads.next_state(events.where("ts <= timestamp_ntz'2024-01-10 00:00:00'"), "ts")
    state = loads.next_state(loads.incremental(events, "ts", before), "ts", before)
    state = loads.next_state(loads.incremental(events, "ts", state), "ts", state)
    return spark.createDataFrame([(state, before)], "first_state timestamp_ntz, state_before timestamp_ntz")


@query(
    """WITH t AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, count(*) AS tests, count(*) FILTER (WHERE n % 2 = 1) AS failed FROM t GROUP BY 1"""
)
def results_documents(spark, sf_dir):
    """A results document for each user, a line each in a few files, parsed again."""
    path, t = scratch_folder(spark, "results"), source(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    one = F.struct(F.concat(F.lit("test.dw.user_"), F.col("user_id").cast("string"), F.lit(".x")).alias("unique_id"), F.when(F.col("n") % 2 == 1, "fail").otherwise("pass").alias("status"), F.col("event_type").alias("message"))
    t.groupBy("user_id").agg(F.to_json(F.struct(F.collect_list(one).alias("results"))).alias("value")).select("value").write.text(path)
    user = F.regexp_extract(c.test_name(F.col("unique_id")), r"(\d+)", 1).cast("long").alias("user_id")
    return scans.read_test_results(spark, path, lines=True).groupBy(user).agg(F.count(F.lit(1)).alias("tests"), F.count(F.when(F.col("status") == "fail", 1)).alias("failed"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def streamed_events(spark, sf_dir):
    """Files that arrive in two lots, each processed once; a third run of the stream finds none."""
    folder, events = scratch_folder(spark, "arrivals"), source(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    for lot in (0, 1, 1):
        if lot == 0 or not exists(spark, f"{folder}/in/lot={lot}"):
            events.where(F.col("event_id") % 2 == lot).write.parquet(f"{folder}/in/lot={lot}")
        stream = file_stream(spark, f"{folder}/in", "event_id long, user_id long, event_type string, value double", "parquet", recursiveFileLookup=True)
        process_files(stream, into(f"{folder}/out"), f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return ledger.read(spark, f"{folder}/out")


@query("SELECT event_id, value, 1::BIGINT AS batches FROM events")
def polled_events(spark, sf_dir):
    """Polling that stops after the first batch with records, and one that finds none and stops after two polls."""
    folder = scratch_folder(spark, "arrivals")
    source(spark, sf_dir, "events").select("event_id", "value").write.parquet(f"{folder}/in")
    told = [poll_files(file_stream(spark, f"{folder}/in", "event_id long, value double", "parquet"), into(f"{folder}/out"), f"{folder}/log", f"{folder}/checkpoint", poll_seconds=1, most_polls=most) for most in (60, 2)]
    return ledger.read(spark, f"{folder}/out").withColumn("batches", F.lit(sum(t.batches for t in told)).cast("long"))


def exists(spark, path: str) -> bool:
    try:
        return not spark.read.parquet(path).isEmpty()
    except Exception as gone:
        if "PATH_NOT_FOUND" in str(gone):
            return False
        raise


@query("SELECT 'late' AS status, count(*) AS events FROM events WHERE event_id % 2 = 1 UNION ALL SELECT 'processed', count(*) FROM events WHERE event_id % 2 = 0")
def late_arrivals(spark, sf_dir):
    """Strict mode: what arrives under a name before the last one is logged as late and left out."""
    folder, events = scratch_folder(spark, "arrivals"), source(spark, sf_dir, "events").select("event_id")
    for lot, rest in (("b", 0), ("a", 1)):
        events.where(F.col("event_id") % 2 == rest).write.parquet(f"{folder}/in/{lot}")
        stream = file_stream(spark, f"{folder}/in", "event_id long", "parquet", recursiveFileLookup=True)
        process_files(stream, into(f"{folder}/out"), f"{folder}/log", f"{folder}/checkpoint", strict=True).awaitTermination()
    status = read_log(spark, f"{folder}/log").select("status", "key").distinct()
    landed = spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/in").select(F.col("_metadata.file_path").alias("key"))
    return landed.join(status, "key").groupBy("status").agg(F.count(F.lit(1)).alias("events"))


@query(
    """SELECT * FROM (VALUES ('unique_order_id', 0::BIGINT, true), ('not_null_order_id', 0::BIGINT, true), ('orders_not_empty', 0::BIGINT, true), ('freshness_orders', 0::BIGINT, true), ('run_duration', 0::BIGINT, true),
('rows_orders', (SELECT count(*) FROM orders), true), ('rows_customers', (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING'), true)) AS t("check", failures, passed)"""
)
def full_job(spark, sf_dir):
    """Load, build, test and judge freshness over the given tables; the counts of the built models come along."""
    folder = scratch_folder(spark, "job")
    customers = source(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "CA").otherwise("XX").alias("state"))
    told = models.full_job(spark, {"orders": raw_orders(spark, sf_dir), "customers": customers}, folder, AS_OF, AS_OF)
    for name, model in (("rows_orders", "stg_orders"), ("rows_customers", "dim_customer")):
        told = told.unionByName(spark.read.parquet(f"{folder}/models/{model}").agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("failures"), F.lit(True).alias("passed")))
    return told


@query("SELECT c_custkey AS customer, c_name AS name, c_mktsegment FROM customer")
def report_job(spark, sf_dir):
    """A query's rows renamed and exported by segment, read back."""
    path = models.run_report(source(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), scratch_folder(spark, "report"), {"c_custkey": "customer", "c_name": "name"}, "{c_mktsegment}", ("c_mktsegment",), AS_OF)
    return spark.read.option("header", True).schema("customer long, name string, c_mktsegment string").csv(path).select("customer", "name", "c_mktsegment")


@query("SELECT count(*) AS failures, count(*) = 0 AS passed, 'staged_orders' AS \"check\" FROM orders WHERE o_totalprice > 400000")
def model_unit_test(spark, sf_dir):
    """A model against expected rows of which the largest amounts are left out."""
    staged = models.stage_orders(raw_orders(spark, sf_dir), as_of=AS_OF)
    expected = staged.where("amount <= 400000").select("order_id", "amount")
    return checks.matches(staged, expected, "staged_orders").select("check", "failures", "passed")


@query(
    """SELECT o_orderkey, nullif(trim(lower(' ' || o_orderpriority)), '') AS priority, CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 2) END AS ratio, isodow(o_orderdate)::INT AS day,
  datediff('day', date_trunc('quarter', o_orderdate), o_orderdate) + 1 AS quarter_day, isodow(o_orderdate) >= 6 AS weekend, '`' || o_orderstatus || '`' AS quoted FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-03 00:00:00'"""
)
def sql_functions(spark, sf_dir):
    c.register_sql_functions(spark)
    source(spark, sf_dir, "orders").createOrReplaceTempView("orders_for_functions")
    return spark.sql(
        """SELECT o_orderkey, clean_string(concat(' ', o_orderpriority)) AS priority, safe_divide(o_totalprice, o_custkey % 2) AS ratio, iso_day_of_week(CAST(o_orderdate AS DATE)) AS day,
        day_of_quarter(CAST(o_orderdate AS DATE)) AS quarter_day, is_weekend(CAST(o_orderdate AS DATE)) AS weekend, quoted_name(o_orderstatus) AS quoted
        FROM orders_for_functions WHERE in_dev_window(o_orderdate, 'dev', 90, DATE '2001-08-01')"""
    )


@query(ORACLES["compare_relations"])
def compare_checksums(spark, sf_dir):
    """The same rows as ``compare_relations``, by checksums of parts first."""
    a = source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    b = a.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return loads.compare_by_checksums(a.drop("o_orderstatus"), b.drop("o_orderstatus"))


@query(ORACLES["snapshot_events"])
def snapshot_ranges(spark, sf_dir):
    """The same rows as ``snapshot_events``, by ranges that a user's events may span."""
    return loads.snapshot_in_ranges(source(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", "ts", "event_id")


@query(
    """SELECT *, failures = 0 AS passed FROM (SELECT 'customers_of_orders' AS "check", (SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)) AS failures
UNION ALL SELECT 'dear_orders_of_lines', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 1000)))"""
)
def integrity_by_bitmaps(spark, sf_dir):
    orders, customer, lineitem = (source(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    return checks.relationships_by_bitmaps(orders, "o_custkey", customer, "c_custkey", "customers_of_orders").unionByName(
        checks.relationships_by_bitmaps(lineitem, "l_orderkey", orders.where("o_totalprice > 1000"), "o_orderkey", "dear_orders_of_lines")
    )


@query(
    """SELECT 'orders' AS tbl, o_orderkey AS id, NULL AS place, o_totalprice AS amount, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status FROM orders
UNION ALL SELECT 'orders__lines', l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) - 1)::VARCHAR, l_extendedprice, NULL FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)"""
)
def inferred_records(spark, sf_dir):
    """Orders with their lines as JSON in two loads, the second with a column more; schemas inferred, lines a table of their own."""
    folder = scratch_folder(spark, "records")
    lines = source(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_extendedprice"))).alias("lines"))
    orders = source(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    for rest, more in ((0, []), (1, ["o_orderstatus"])):
        some = orders.where(F.col("o_orderkey") % 2 == rest)
        record = F.struct(F.col("o_orderkey").alias("id"), F.struct(F.col("o_totalprice").alias("total")).alias("price"), "lines", *more)
        path = scratch_folder(spark, "landing")
        some.select(F.to_json(record).alias("value")).write.text(path)
        places = inferred.load_records(spark, spark.read.text(path), folder, "orders", "id")
    head, items = ledger.read(spark, places["orders"]), ledger.read(spark, places["orders__lines"])
    no = F.lit(None).cast("string")
    head = head.select(F.lit("orders").alias("tbl"), "id", no.alias("place"), F.col("price__total").alias("amount"), F.col("o_orderstatus").alias("status"))
    return head.unionByName(items.select(F.lit("orders__lines").alias("tbl"), "id", F.col("_position").alias("place"), F.col("l_extendedprice").cast("double").alias("amount"), no.alias("status")))


@query("SELECT 'batch' AS way, event_id, value FROM events UNION ALL SELECT 'stream', event_id, value FROM events")
def generated_events(spark, sf_dir):
    """A generator that pages through the events, read by four tasks, and as a stream that is stopped and goes on."""
    what = {"schema": "event_id bigint, value double", "make": "brindle.sources.generated:table_items", "size": "brindle.sources.generated:table_rows", "tasks": 4, "path": f"{sf_dir}/events.parquet", "columns": "event_id,value"}
    folder, rows = scratch_folder(spark, "generated"), source(spark, sf_dir, "events").count()
    for upto in (rows // 2, rows):
        stream = generated.stream_generator(spark, **what, upto=upto)
        sink = into(f"{folder}/out")
        run = lambda df, n: sink(df, df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), n)  # noqa: B023, E731
        stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    batch = generated.read_generator(spark, **what)
    return batch.select(F.lit("batch").alias("way"), "*").unionByName(ledger.read(spark, f"{folder}/out").select(F.lit("stream").alias("way"), "*"))


UPSERTED = """
WITH b AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, 'batch' AS origin FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 10 FROM orders)
  UNION ALL SELECT -o_orderkey - 1, o_totalprice, 'batch' FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 100 FROM orders))
SELECT * FROM b UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
"""


def upserted_orders(spark, sf_dir):
    """Orders stored in ten files, a tenth of them upserted with some new ones; the table's path and its files before."""
    path, orders = scratch_folder(spark, "orders"), source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    before = stored.create(orders, path, ["o_orderkey"], 10)
    top = orders.agg(F.max("o_orderkey")).first()[0]
    batch = orders.where(F.col("o_orderkey") <= top // 10).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = orders.where(F.col("o_orderkey") <= top // 100).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    stored.upsert(batch.unionByName(new).withColumn("origin", F.lit("batch")), path, [F.desc("o_totalprice")])
    return path, before


@query(UPSERTED)
def upsert_stored(spark, sf_dir):
    path, _ = upserted_orders(spark, sf_dir)
    return ledger.read(spark, path)


@query("SELECT 10::BIGINT AS files_before, true AS most_files_stay, (SELECT count(*) FROM (" + UPSERTED + ")) AS rows")
def upsert_touches(spark, sf_dir):
    """Files without a key of the batch keep their names: all but two of ten at most."""
    path, before = upserted_orders(spark, sf_dir)
    after = ledger.version(spark, path)
    stay = len(before.files.keys() & after.files.keys())
    return ledger.read(spark, path).agg(F.lit(len(before.files)).cast("long").alias("files_before"), F.lit(stay >= len(before.files) - 2).alias("most_files_stay"), F.count(F.lit(1)).alias("rows"))


@query("SELECT event_id, user_id, ts, value FROM events")
def durable_increment(spark, sf_dir):
    """Events in two loads by time; the second looks back three days and leaves out what is there, a third finds none."""
    path, events = scratch_folder(spark, "events"), source(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    stored.load_increment(events.where((F.col("ts") <= F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("event_id") % 10 > 0)), path, "ts", ["event_id"])
    stored.load_increment(events, path, "ts", ["event_id"], "40 days")
    stored.load_increment(events, path, "ts", ["event_id"])
    return ledger.read(spark, path)


@query(
    """SELECT * FROM (VALUES ('after', true, true, true), ('before', false, true, true)) AS t(state, healthy, large_file_stays, rows_same)"""
)
def compacted_in_place(spark, sf_dir):
    """A table with large files and many small ones, before and after its small files are put together.

    There are more files, not larger ones, where there are more rows, so that no task writes or reads more than a few of them.
    """
    path, items = scratch_folder(spark, "lineitem"), source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    wanted = max(1, math.ceil(items.count() / FILE_ROWS))
    stored.create(items, path, ["l_orderkey", "l_linenumber"], wanted)
    large = ledger.version(spark, path).files
    small = min(f.bytes for f in large.values())
    for rest in range(4):
        ledger.append(items.where(F.col("l_linenumber") % 4 == rest).repartition(3 * wanted), path)
    before, rows = stored.health(spark, {"lineitem": path}, small), ledger.read(spark, path).count()
    before = before.collect()
    done = stored.maintain(spark, {"lineitem": path}, small=small, target=4 * small)
    after = stored.health(spark, {"lineitem": path}, small).collect()
    told = [(name, r.n_small <= 1, set(large) <= set(ledger.version(spark, path).files), r.n_rows == rows) for name, (r,) in (("before", before), ("after", after))]
    assert done == ["lineitem"]
    return spark.createDataFrame(told, "state string, healthy boolean, large_file_stays boolean, rows_same boolean")


@query(
    """SELECT 'after' AS state, 'wide_orders' AS relname, count(*) AS n_rows, false AS sick FROM orders UNION ALL SELECT 'after', 'tidy_orders', count(*), false FROM orders
UNION ALL SELECT 'before', 'wide_orders', count(*), true FROM orders UNION ALL SELECT 'before', 'tidy_orders', count(*), false FROM orders"""
)
def unhealthy_tables(spark, sf_dir):
    """Two tables of the catalog, before and after maintenance: the one with many small files and no statistics is mended."""
    orders, own = source(spark, sf_dir, "orders"), uuid.uuid4().hex[:12]
    names = wide, tidy = f"default.wide_orders_{own}", f"default.tidy_orders_{own}"
    told = []
    try:
        # more files for more rows, not larger ones; by the source's bytes, as rows in other orders may take more
        large = shaping.files_for(orders)
        for name, df in ((wide, orders.repartition(6 * large)), (tidy, orders.repartition(large))):
            loads.materialize_table(df, name, scratch_folder(spark, "orders"))
        shaping.analyze(spark, tidy)
        for state in ("before", "after"):
            health = shaping.table_health(spark, list(names))
            sick = shaping.unhealthy(health)
            told += [(state, r.relname.removesuffix(f"_{own}"), r.n_rows, r.sick is not None) for r in health.join(sick.select("relname", F.lit(True).alias("sick")), "relname", "left").collect()]
            shaping.maintain(sick, scratch_folder(spark, "maintained"))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(told, "state string, relname string, n_rows long, sick boolean")
