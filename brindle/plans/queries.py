"""The registered queries over the tables given, each with the SQL that it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions import columns as c
from brindle.functions.calendar import holidays
from brindle.operators import checks, exports, filters, loads, shaping
from brindle.plans import models
from brindle.sources.scans import after_cursor, source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
AS_OF = datetime(2001, 8, 1)
EVENTS_AS_OF = datetime(2024, 1, 31)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = source(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("status"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("created_at"))


STAGED = """
SELECT o_orderkey AS order_id, nullif(trim(lower('  ' || o_orderpriority || ' ')), '') AS status, o_totalprice AS amount,
       o_orderdate AS created_at, o_orderdate AS _loaded_at, TIMESTAMP '2001-08-01 00:00:00' AS _updated_at FROM orders
"""


@query(STAGED)
def stg_orders(spark, sf_dir):
    return models.stage_orders(raw_orders(spark, sf_dir), "prod", as_of=AS_OF, loaded_at="created_at")


@query(STAGED + "WHERE o_orderdate >= TIMESTAMP '2001-05-03 00:00:00'")
def stg_orders_dev(spark, sf_dir):
    return models.stage_orders(raw_orders(spark, sf_dir), "dev", days=90, as_of=AS_OF, loaded_at="created_at")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice::DOUBLE / l_discount::DOUBLE END AS ratio FROM lineitem")
def safe_divide(spark, sf_dir):
    return source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c.safe_divide(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio"))


@query("SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def dim_customer(spark, sf_dir):
    return models.dim_customer(source(spark, sf_dir, "customer"), ["BUILDING", "MACHINERY"], "c_custkey", "c_mktsegment")


HOLIDAYS = """
b AS (SELECT date_trunc('year', min(o_orderdate))::DATE AS s, (date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR)::DATE AS e FROM orders),
y AS (SELECT unnest(range(year(s), year(e) + 2)) AS y FROM b),
d AS (SELECT unnest(range(make_date(y, 1, 1)::TIMESTAMP, make_date(y + 1, 1, 1)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM y),
f AS (SELECT d, CASE isodow(d) WHEN 6 THEN d - 1 WHEN 7 THEN d + 1 ELSE d END::DATE AS w, month(d) AS m, day(d) AS k, isodow(d) AS o FROM d),
h AS (
  SELECT w AS date_key, CASE m WHEN 1 THEN 'New Years Day' WHEN 7 THEN 'July 4th' ELSE 'Christmas' END AS holiday FROM f WHERE (m, k) IN ((1, 1), (7, 4), (12, 25))
  UNION ALL SELECT w, 'Juneteenth' FROM f WHERE m = 6 AND k = 19 AND w >= DATE '2021-06-17'
  UNION ALL SELECT d, 'Birthday of Martin Luther King, Jr.' FROM f WHERE m = 1 AND o = 1 AND k BETWEEN 15 AND 21
  UNION ALL SELECT d, 'Washington’s Birthday' FROM f WHERE m = 2 AND o = 1 AND k BETWEEN 15 AND 21
  UNION ALL SELECT d, 'Memorial Day' FROM f WHERE m = 5 AND o = 1 AND k >= 25
  UNION ALL SELECT d, 'Labor Day' FROM f WHERE m = 9 AND o = 1 AND k <= 7
  UNION ALL SELECT d, 'Columbus Day' FROM f WHERE m = 10 AND o = 1 AND k BETWEEN 8 AND 14
  UNION ALL SELECT d, 'Thanksgiving Day' FROM f WHERE m = 11 AND o = 4 AND k BETWEEN 22 AND 28
  UNION ALL SELECT d + 1, 'Thanksgiving Friday' FROM f WHERE m = 11 AND o = 4 AND k BETWEEN 22 AND 28),
r AS (SELECT date_key::DATE AS date_key, holiday FROM h, b WHERE date_key >= s AND date_key < e)
"""


@query("WITH " + HOLIDAYS + "SELECT r.date_key, r.holiday, count(o_orderkey) AS orders FROM r LEFT JOIN orders ON o_orderdate::DATE = r.date_key GROUP BY 1, 2")
def orders_on_holidays(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    days = holidays(models.calendar_of(orders, "o_orderdate"))
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))
    return days.join(per_day, "date_key", "left").select("date_key", "holiday", F.coalesce("orders", F.lit(0)).alias("orders"))


@query(
    "WITH "
    + HOLIDAYS
    + """, s AS (SELECT unnest(range(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM b)
SELECT strftime(d, '%Y%m%d') AS date_key, d AS calendar_date, dayname(d) AS day_name, left(dayname(d), 3) AS day_name_abbreviated,
  isodow(d)::VARCHAR AS day_of_week, strftime(d, '%d') AS day_of_month, ((day(d) - 1) // 7 + 1)::VARCHAR AS week_of_month,
  (datediff('day', date_trunc('quarter', d), d) + 1)::VARCHAR AS day_of_quarter, strftime(d, '%j') AS day_of_year,
  lpad(((dayofyear(d) - 1) // 7 + 1)::VARCHAR, 2, '0') AS week_of_year, strftime(d, '%m') AS month_of_year, monthname(d) AS month_name,
  left(monthname(d), 3) AS month_name_abbreviated, quarter(d)::VARCHAR AS quarter_actual, strftime(d, '%Y') AS year_actual,
  r.holiday IS NOT NULL AS is_holiday, coalesce(r.holiday, 'NOT A HOLIDAY') AS holiday_name, isodow(d) >= 6 AS is_weekend,
  (SELECT count(*) FROM orders WHERE o_orderdate::DATE = s.d) AS orders
FROM s LEFT JOIN r ON r.date_key = s.d"""
)
def dim_date(spark, sf_dir):
    """The date dimension over the years of the orders, with each day's orders."""
    orders = source(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("calendar_date")).agg(F.count(F.lit(1)).alias("orders"))
    days = models.date_dimension(models.calendar_of(orders, "o_orderdate"))
    return days.join(per_day, "calendar_date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
FAILS = {
    "unique_o_orderkey": "SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    "unique_o_custkey": "SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    "not_null_o_orderkey": "SELECT count(*) FROM orders WHERE o_orderkey IS NULL",
    "not_null_o_custkey": "SELECT count(*) FROM orders WHERE o_custkey IS NULL",
    "orders_not_empty": "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM orders",
    "positive_amount": "SELECT count(*) FROM orders WHERE o_totalprice <= 0",
    "accepted_values_o_orderpriority": "SELECT count(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    "relationships_o_custkey": "SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)",
    "relationships_l_orderkey": "SELECT count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)",
    "orders_columns": "SELECT CASE WHEN count(*) = 6 THEN 0 ELSE 1 END FROM (DESCRIBE orders)",
    "type_o_totalprice": "SELECT CASE WHEN bool_and(typeof(o_totalprice) = 'DOUBLE') THEN 0 ELSE 1 END FROM orders",
}
CHECKS_SQL = "SELECT \"check\", failures::BIGINT AS failures, failures = 0 AS passed FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", ({v}) AS failures" for k, v in FAILS.items()) + ")"


@query(CHECKS_SQL)
def data_quality(spark, sf_dir):
    orders, customer, lineitem = (source(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    row_by_row = {
        "not_null_o_orderkey": F.col("o_orderkey").isNull(),
        "not_null_o_custkey": F.col("o_custkey").isNull(),
        "positive_amount": F.col("o_totalprice") <= 0,
        "accepted_values_o_orderpriority": ~F.col("o_orderpriority").isin(PRIORITIES),
    }
    return checks.report(
        checks.row_checks(orders, row_by_row, "orders_not_empty"),
        checks.unique(orders, "o_orderkey"),
        checks.unique(orders, "o_custkey"),
        checks.relationships(orders, "o_custkey", customer, "c_custkey"),
        checks.relationships(lineitem, "l_orderkey", orders, "o_orderkey"),
        checks.column_count(orders, 6, "orders_columns"),
        checks.column_type(orders, "o_totalprice", "double"),
    )


@query(
    "WITH r AS ("
    + CHECKS_SQL
    + """), f AS (SELECT count(*) AS total, count(*) FILTER (WHERE NOT passed) AS failed,
  string_agg("check" || ' - Got ' || failures || ' results', chr(10) ORDER BY "check" || ' - Got ' || failures || ' results') FILTER (WHERE NOT passed) AS lines FROM r)
SELECT total, failed, CASE WHEN failed > 0 THEN failed || ' of ' || total || ' tests failed in last run:' || chr(10) || lines
  ELSE 'All ' || total || ' tests passed in last run.' END AS report FROM f"""
)
def test_report(spark, sf_dir):
    found = data_quality(spark, sf_dir)
    message = F.concat(F.lit("Got "), F.col("failures").cast("string"), F.lit(" results, configured to fail if != 0"))
    return checks.test_report(found.select(F.concat(F.lit("test.dw."), "check", F.lit(".1a2b")).alias("unique_id"), F.when(F.col("passed"), "pass").otherwise("fail").alias("status"), message.alias("message")))


@query(
    """WITH l AS (SELECT event_type AS asset, max(ts) AS last_loaded FROM events GROUP BY 1), x AS (SELECT asset FROM l UNION ALL SELECT 'never_loaded'),
a AS (SELECT x.asset, last_loaded, epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_loaded) AS us FROM x LEFT JOIN l ON l.asset = x.asset)
SELECT asset, last_loaded, round(us / 1e6 / 3600, 2) AS age_hours, 25.0::DOUBLE AS threshold_hours, coalesce(us / 1e6 / 3600 <= 25, false) AS passed,
  CASE WHEN last_loaded IS NULL THEN 'Asset has never been loaded.' WHEN us / 1e6 / 3600 > 25 THEN 'Last load is too old.' END AS reason, 'WARN' AS severity FROM a"""
)
def freshness(spark, sf_dir):
    log = source(spark, sf_dir, "events").select(F.col("event_type").alias("asset"), F.col("ts").alias("loaded_at"))
    expected = log.select("asset").distinct().union(log.agg(F.lit("never_loaded")))
    return checks.freshness(log, expected, as_of=EVENTS_AS_OF)


@query(
    """WITH r AS (SELECT user_id, min(ts) AS pipeline_start FROM events GROUP BY 1), a AS (SELECT *, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(pipeline_start)) / 1e6 / 3600 AS h FROM r)
SELECT user_id, pipeline_start, round(h, 2) AS elapsed_hours, 700.0::DOUBLE AS threshold_hours, h <= 700 AS passed FROM a"""
)
def run_duration(spark, sf_dir):
    runs = source(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("pipeline_start"))
    return checks.run_duration(runs, hours=700.0, as_of=EVENTS_AS_OF)


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_extract(spark, sf_dir):
    return loads.incremental(source(spark, sf_dir, "events"), "ts", datetime(2024, 1, 15))


UPSERT_SQL = """
WITH t AS (SELECT * FROM orders WHERE o_orderstatus <> 'O'), n AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_totalprice > 200000)
SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL SELECT * FROM n
"""


@query(UPSERT_SQL)
def upsert_orders(spark, sf_dir):
    """Run twice over: the second upsert of the same batch changes nothing."""
    orders = source(spark, sf_dir, "orders")
    batch = orders.where("o_totalprice > 200000").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    twice = batch.union(batch)
    once = loads.upsert(orders.where("o_orderstatus <> 'O'"), twice, ["o_orderkey"], [F.desc("o_orderdate")])
    return loads.upsert(once, batch, ["o_orderkey"], [F.desc("o_orderdate")])


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def append_orders(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    return loads.append(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'"))


@query("SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value FROM events")
def reload_batch(spark, sf_dir):
    events = source(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return loads.reload_batch(events, events.where("event_type = 'click'").withColumn("value", F.col("value") * 2), "event_type", "click")


SNAPSHOT_SQL = """
SELECT user_id, event_id, ts, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(event_id) OVER w IS NULL AS is_current
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
"""


@query(SNAPSHOT_SQL)
def snapshot_events(spark, sf_dir):
    return loads.snapshot(source(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", "ts", "event_id")


@query(SNAPSHOT_SQL)
def snapshot_merge(spark, sf_dir):
    events = source(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    cut = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    first = loads.snapshot(events.where(F.col("ts") < cut), "user_id", "ts", "event_id")
    return loads.snapshot_merge(first, events.where(F.col("ts") >= F.date_sub(cut.cast("date"), 2).cast("timestamp_ntz")), "user_id", "ts", "event_id")


@query("SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_event(spark, sf_dir):
    return loads.latest_per_key(source(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query("SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS sequence FROM events")
def event_sequence(spark, sf_dir):
    return loads.numbered(source(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "event_type", "sequence")


@query(
    """WITH a AS (SELECT o_orderkey, o_totalprice FROM orders), b AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders)
SELECT *, true AS in_a, false AS in_b FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, false, true FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""
)
def compare_relations(spark, sf_dir):
    a = source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    b = a.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return loads.compare(a.drop("o_orderstatus"), b.drop("o_orderstatus"))


@query("SELECT 'customers_' || lower(c_mktsegment) || '_' || c_nationkey || '_20240131.csv' AS file, count(*) AS rows FROM customer GROUP BY 1")
def grouped_export(spark, sf_dir):
    named = exports.with_file(source(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"], "customers_{c_mktsegment}_{c_nationkey}", {"c_mktsegment": F.lower}, EVENTS_AS_OF)
    return exports.manifest(named)


@query("SELECT event_type || '_' || user_id || '.csv' AS file, count(*) AS rows FROM (SELECT * FROM events UNION ALL SELECT * FROM events) GROUP BY 1")
def grouped_export_of_frames(spark, sf_dir):
    events = source(spark, sf_dir, "events")
    return exports.manifest(exports.with_file([events, events], ["event_type", "user_id"]))


@query("SELECT c_custkey AS customer, c_name AS name, c_acctbal FROM customer")
def rename_columns(spark, sf_dir):
    return exports.rename_columns(source(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), {"c_custkey": "customer", "c_name": "name", "missing": "x"})


@query("SELECT event_id AS id, upper(event_type) AS value, 'events' AS source, true AS transformed FROM events")
def enrich_records(spark, sf_dir):
    return shaping.enrich(source(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("value"), F.lit("events").alias("source")))


@query("SELECT count(*) AS records, 'Loaded ' || count(*) || ' records successfully' AS summary FROM events")
def load_summary(spark, sf_dir):
    return shaping.load_summary(source(spark, sf_dir, "events"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def parse_props(spark, sf_dir):
    return source(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


LOGS = """
WITH t AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
l AS (SELECT user_id, 'Finished running ' || count(*) || ' tests in 0 hours 1 minutes and 2.50 seconds (62.50s).' AS summary,
  'Done. PASS=' || count(*) FILTER (WHERE n % 2 = 0) || ' WARN=0 ERROR=' || count(*) FILTER (WHERE n % 2 = 1) || ' SKIP=0 TOTAL=' || count(*) AS status,
  list_filter(list(CASE WHEN n % 2 = 1 THEN 'Failure in test ' || event_type END ORDER BY event_type), lambda x: x IS NOT NULL) AS notable,
  list_filter(list(CASE WHEN n % 2 = 1 THEN 'Failure in test ' || event_type || ' Got ' || n || ' results' END ORDER BY event_type), lambda x: x IS NOT NULL) AS counts FROM t GROUP BY 1)
SELECT user_id, summary, status, array_to_string(notable, ',') AS notable, array_to_string(counts, ',') AS counts, len(notable) AS n_failures FROM l
"""


@query(LOGS)
def mine_test_logs(spark, sf_dir):
    """One test log per user, written from the events and mined again."""
    t = source(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    odd = F.col("n") % 2 == 1
    line = F.when(odd, F.format_string("\x1b[31mFailure in test %s (models/x.yml)\x1b[0m\n  Got %d results, configured to fail\n", "event_type", "n"))
    n = F.count(F.lit(1))
    logs = t.groupBy("user_id").agg(
        F.concat(
            F.format_string("Finished running %d tests in 0 hours 1 minutes and 2.50 seconds (62.50s).\n", n),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.when(odd, F.struct("event_type", line.alias("line"))))), lambda s: s["line"]), ""),
            F.format_string("Done. PASS=%d WARN=0 ERROR=%d SKIP=0 TOTAL=%d", F.count(F.when(~odd, 1)), F.count(F.when(odd, 1)), n),
        ).alias("log")
    )
    mined = checks.mine_test_logs(logs)
    return mined.select("user_id", "summary", "status", F.array_join("notable", ",").alias("notable"), F.array_join("counts", ",").alias("counts"), "n_failures")


EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS \"{t}\"" for t in EVENT_TYPES) + " FROM events GROUP BY 1")
def pivot_events(spark, sf_dir):
    return shaping.pivot_counts(source(spark, sf_dir, "events"), "user_id", "event_type", EVENT_TYPES)


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN o_orderstatus = 'O' THEN 'Open' END AS description FROM orders")
def case_mapping(spark, sf_dir):
    return source(spark, sf_dir, "orders").select("o_orderkey", c.case_map(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"}).alias("description"))


@query("SELECT event_id, date_trunc('second', ts) + INTERVAL 9 HOUR AS local_time FROM events")
def epoch_to_local_time(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return source(spark, sf_dir, "events").select("event_id", c.epoch_ms_to_timestamp(ms, "Asia/Tokyo").alias("local_time"))


@query("SELECT l_orderkey, l_linenumber, md5(coalesce(l_orderkey::VARCHAR, '_null_') || '-' || coalesce(nullif(l_linenumber, 1)::VARCHAR, '_null_')) AS line_key FROM lineitem")
def surrogate_key(spark, sf_dir):
    return source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c.surrogate_key(F.col("l_orderkey"), F.nullif(F.col("l_linenumber"), F.lit(1))).alias("line_key"))


@query("SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag IN ('A', 'R')")
def joined_lines(spark, sf_dir):
    lines = filters.in_values(source(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "R"])
    return source(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "inner").select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def largest_orders(spark, sf_dir):
    return source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query(
    """SELECT schemaname, relname, n_dead, n_live, 'ANALYZE TABLE `' || schemaname || '`.`' || relname || '` COMPUTE STATISTICS;' AS command
FROM (SELECT lower(l_returnflag) AS schemaname, 'supplier_' || l_suppkey AS relname, count(*) FILTER (WHERE l_quantity < 2) AS n_dead, count(*) FILTER (WHERE l_quantity >= 2) AS n_live FROM lineitem GROUP BY 1, 2)
WHERE schemaname IN ('a', 'r') AND n_dead > 0"""
)
def maintenance_candidates(spark, sf_dir):
    few = F.col("l_quantity") < 2
    stats = source(spark, sf_dir, "lineitem").groupBy(F.lower("l_returnflag").alias("schemaname"), F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("relname"))
    return shaping.maintenance_candidates(stats.agg(F.count(F.when(few, 1)).alias("n_dead"), F.count(F.when(~few, 1)).alias("n_live")), ["a", "r"])


@query("SELECT count(*) AS running, count(*) > 0 AS is_running FROM orders WHERE o_orderstatus <> 'F' AND (o_orderpriority ILIKE '%urgent%') AND NOT o_orderpriority ILIKE '%low%'")
def active_statements(spark, sf_dir):
    activity = source(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", "idle").otherwise("active").alias("state"), F.concat(F.lit("analyze table "), "o_orderpriority").alias("query"))
    n = F.count(F.lit(1))
    return filters.active_statements(activity, "%URGENT%", "%LOW%").agg(n.alias("running"), (n > 0).alias("is_running"))


@query("SELECT 'inbound/' || lpad(event_id::VARCHAR, 12, '0') || '.csv' AS key, value AS size FROM events WHERE 'inbound/' || lpad(event_id::VARCHAR, 12, '0') || '.csv' > 'inbound/000000000100.csv'")
def files_after_cursor(spark, sf_dir):
    listing = source(spark, sf_dir, "events").select(F.concat(F.lit("inbound/"), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit(".csv")).alias("key"), F.col("value").alias("size"))
    return after_cursor(listing, "inbound/000000000100.csv")


@query("SELECT asset, error FROM (SELECT event_type || '_' || event_id AS asset, left(repeat(props, 80), 500) AS error FROM events)")
def shortened_errors(spark, sf_dir):
    return source(spark, sf_dir, "events").select(F.concat("event_type", F.lit("_"), F.col("event_id").cast("string")).alias("asset"), c.shortened(F.repeat("props", 80)).alias("error"))
