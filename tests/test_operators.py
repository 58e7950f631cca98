from __future__ import annotations

from datetime import date, datetime
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from brindle.functions import columns as c
from brindle.functions.calendar import date_spine, dim_date, holidays
from brindle.operators import checks, exports, filters, loads, shaping
from brindle.plans import models
from brindle.sources import scans


def bounds(spark, start, end):
    return spark.createDataFrame([(start, end)], "start date, end date")


def test_staged_orders_golden(spark):
    raw = spark.createDataFrame([(1, "  ACTIVE  ", 100, date(2024, 1, 1)), (2, "", 200, date(2024, 1, 2)), (3, " Pending ", 0, date(2024, 1, 3))], "id long, status string, amount long, created_at date")
    out = models.stage_orders(raw, as_of=datetime(2024, 2, 1))
    assert [tuple(r) for r in out.select("order_id", "status", "amount").orderBy("order_id").collect()] == [(1, "active", 100), (2, None, 200), (3, "pending", 0)]
    assert out.columns == ["order_id", "status", "amount", "created_at", "_loaded_at", "_updated_at"]


def test_dev_limit_is_inclusive_and_drops_null_dates(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 7)), (2, datetime(2024, 1, 6, 23)), (3, None)], "id long, t timestamp_ntz")
    as_of = datetime(2024, 1, 10, 15)
    assert [r.id for r in filters.limit_data_in_dev(df, "t", "dev", 3, as_of).collect()] == [1]
    assert filters.limit_data_in_dev(df, "t", "prod", 3, as_of).count() == 3


def test_dev_limit_reaches_the_scan(spark, sf_dir):
    df = filters.limit_data_in_dev(scans.source(spark, sf_dir, "orders"), "o_orderdate", "dev", 3, datetime(2001, 8, 1)).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "o_totalprice" not in plan


def test_in_values(spark):
    df = spark.createDataFrame([(1, "CA"), (2, "XX"), (3, None)], "id long, state string")
    assert [r.customer_id for r in models.dim_customer(df).collect()] == [1]
    assert filters.in_values(df, "state", []).count() == 0
    assert filters.in_values(df, "id", list(range(3, 500))).count() == 1
    assert len(models.US_STATES) == 59


def test_safe_divide_and_clean_string(spark):
    df = spark.createDataFrame([(1.0, 0.0, "\tA "), (1.0, None, ""), (3.0, 2.0, None)], "n double, d double, s string")
    got = df.select(c.safe_divide(F.col("n"), F.col("d")), c.clean_string(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(None, "\ta"), (None, None), (1.5, None)]


def test_sql_functions(spark):
    c.register_sql_functions(spark)
    assert tuple(spark.sql("SELECT clean_string('  X '), safe_divide(1, 0), iso_day_of_week(DATE '2024-01-07')").first()) == ("x", None, 7)


def test_holiday_rules(spark):
    got = {(str(r.date_key), r.holiday) for r in holidays(bounds(spark, date(2010, 1, 1), date(2030, 1, 1))).collect()}
    assert len(got) == 209
    assert {("2010-12-31", "New Years Day"), ("2021-12-31", "New Years Day"), ("2021-06-18", "Juneteenth"), ("2010-02-15", "Washington’s Birthday"), ("2029-12-25", "Christmas")} <= got
    assert min(d for d, n in got if n == "Juneteenth") == "2021-06-18"


def test_date_dimension(spark):
    b = bounds(spark, date(2010, 1, 1), date(2030, 1, 1))
    out = dim_date(date_spine(b), holidays(b))
    n = out.agg(F.count("*").alias("n"), F.countDistinct("date_key").alias("k"), F.sum(F.col("is_holiday").cast("int")).alias("h"), F.sum(F.col("is_weekend").cast("int")).alias("w")).first()
    assert tuple(n) == (7305, 7305, 209, 2088)
    assert checks.not_null(out, out.columns).where("NOT passed").count() == 0
    row = out.where("date_key = '20240229'").first()
    assert (row.day_name, row.day_of_week, row.week_of_month, row.day_of_quarter, row.day_of_year, row.week_of_year) == ("Thursday", "4", "5", "60", "060", "09")
    assert date_spine(bounds(spark, date(2024, 1, 1), date(2024, 1, 1))).count() == 0


def test_upsert_three_times(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, t long")
    batch = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1), (None, "x", 9)], "k long, v string, t long")
    out = target
    for _ in range(3):
        out = loads.upsert(out, batch, ["k"], [F.desc("t")])
    assert sorted(map(tuple, out.collect())) == [(1, "a", 1), (2, "d", 3), (3, "e", 1)]


def test_incremental_keeps_state_without_rows(spark):
    df = spark.createDataFrame([(1,), (5,)], "t long")
    assert loads.incremental(df, "t", 1).collect()[0].t == 5
    assert loads.next_state(df, "t") == 5
    assert loads.next_state(loads.incremental(df, "t", 5), "t", 5) == 5


def test_reload_batch_keeps_rows_without_run(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "run string, v long")
    out = loads.reload_batch(t, spark.createDataFrame([("a", 9)], "run string, v long"), "run", "a")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", 9), ("b", 2), (None, 3)], key=str)


def test_writes_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5).withColumn("run", F.lit("r1"))
    loads.load({"t": df}, str(tmp_path))
    loads.write_replaced(spark.read.parquet(path).where("id < 3"), path)
    assert spark.read.parquet(path).count() == 3
    runs = str(tmp_path / "runs")
    for n in (2, 3, 3):
        loads.write_run(spark.range(n).withColumn("run", F.lit("r2")), runs, "run")
    loads.write_run(df, runs, "run")
    assert spark.read.parquet(runs).groupBy("run").count().orderBy("run").collect()[1]["count"] == 3
    loads.write_appended(df, path)
    assert spark.read.parquet(path).count() == 8


def test_schema_evolution(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.write_appended(spark.createDataFrame([(1, "a")], "id long, x string"), path)
    loads.write_appended(spark.createDataFrame([(2, 5)], "id int, y int"), path)
    assert sorted(map(tuple, loads.read_evolved(spark, path).select("id", "x", "y").collect())) == [(1, "a", None), (2, None, 5)]
    a, b = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string"), spark.createDataFrame([(2, 7)], "id long, y int")
    assert sorted(map(tuple, loads.append(a, b).collect()), key=str) == [(1, "a", None), (2, "b", None), (2, None, 7)]
    assert sorted(map(tuple, loads.upsert(a, b, ["id"], [F.col("y")]).collect())) == [(1, "a", None), (2, None, 7)]
    with pytest.raises(TypeError, match="column x holds string, not int"):
        loads.append(a, spark.createDataFrame([(3, 4)], "id int, x int"))
    assert loads.append(a, spark.createDataFrame([(3, None)], "id int, x void")).where("x IS NULL").count() == 1


def test_a_failed_move_keeps_the_old_content(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    loads.write_replaced(spark.range(3), path)
    with pytest.raises(Exception):
        loads.write_replaced(spark.range(3).select(F.raise_error(F.lit("no"))), path)
    assert spark.read.parquet(path).count() == 3
    loads.write_replaced(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4 and [p.name for p in tmp_path.iterdir() if "replaced" in p.name] == []


def test_snapshot_merge_touches_the_keys_of_the_batch(spark):
    history = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "k string, t long")
    first = loads.snapshot(history, "k", "t").withColumn("valid_to", F.when(F.col("k") == "b", 99).otherwise(F.col("valid_to")))
    batch = spark.createDataFrame([("a", 3), ("a", 2), (None, 5), ("c", 1)], "k string, t long")
    got = {(r.k, r.t): (r.valid_to, r.is_current) for r in loads.snapshot_merge(first, batch, "k", "t").collect()}
    assert got == {("a", 1): (2, False), ("a", 2): (3, False), ("a", 3): (None, True), ("b", 1): (99, True), (None, 1): (5, False), (None, 5): (None, True), ("c", 1): (None, True)}


def test_resources_that_are_made(spark):
    made = scans.make_resources(spark, {"n": lambda s: s.range(3)})
    assert made["n"].count() == 3
    with pytest.raises(ValueError, match="repeats"):
        scans.make_resources(spark, {"n": lambda s: s.range(3).select("id", F.col("id").alias("ID"))})


def test_table_health(spark):
    spark.range(50).repartition(5).write.mode("overwrite").saveAsTable("default.many_files")
    health = shaping.table_health(spark, ["default.many_files"])
    assert tuple(health.select("n_files", "n_small", "n_rows", "n_known").first()) == (5, 5, 50, None)
    shaping.analyze(spark, "default.many_files")
    assert shaping.table_health(spark, ["default.many_files"]).first().n_known == 50
    assert shaping.unhealthy(health, most_small=5).first().command == "ANALYZE TABLE `default`.`many_files` COMPUTE STATISTICS;"
    assert shaping.unhealthy(shaping.table_health(spark, ["default.many_files"]), most_small=5).count() == 0


def test_materializations(spark):
    df = spark.range(3)
    assert loads.materialize_view(df, "some_view").count() == 3
    for _ in range(2):
        assert loads.materialize_table(df, "some_table").count() == 3
    shaping.analyze(spark, "some_table")


def test_compare(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x long")
    b = spark.createDataFrame([(1,), (3,)], "x long")
    assert sorted(map(tuple, loads.compare(a, b).collect())) == [(1, True, False), (2, True, False), (3, False, True)]


def test_freshness(spark):
    log = spark.createDataFrame([("a", datetime(2024, 1, 2, 11)), ("b", datetime(2024, 1, 1, 6)), ("c", datetime(2024, 1, 1, 11))], "asset string, loaded_at timestamp_ntz")
    expected = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "asset string")
    got = {r.asset: r for r in checks.freshness(log, expected, as_of=datetime(2024, 1, 2, 12)).collect()}
    assert (got["a"].passed, got["a"].age_hours) == (True, 1.0)
    assert not got["b"].passed and got["b"].age_hours == 30.0
    assert got["c"].passed  # 25 hours, inclusive
    assert not got["d"].passed and "never" in got["d"].reason


def test_run_duration_raises(spark):
    runs = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 2, 5),)], "pipeline_start timestamp_ntz")
    judged = checks.run_duration(runs, as_of=datetime(2024, 1, 2, 6))
    with pytest.raises(ValueError, match="exceeded"):
        checks.raise_if_exceeded(judged)
    assert checks.raise_if_exceeded(judged.where("passed")).count() == 1


def test_checks_on_bad_data(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "z")], "k long, s string")
    out = checks.report(checks.unique(df, "k"), checks.not_null(df, ["k", "s"]), checks.not_empty(df.limit(0)), checks.accepted_values(df, "s", ["x"]), checks.relationships(df, "k", spark.range(1), "id"), checks.column_count(df, 3), checks.column_type(df, "k", "bigint"))
    assert {r.check: r.failures for r in out.collect()} == {"unique_k": 1, "not_null_k": 1, "not_null_s": 1, "not_empty": 1, "accepted_values_s": 1, "relationships_k": 2, "column_count": 1, "type_k": 0}


def test_test_report(spark):
    rows = [("test.dw.unique_id.ab", "fail", "Got 2 results, configured"), ("test.dw.nn.cd", "pass", None), ("test.dw.rel.ef", "fail", None)]
    df = spark.createDataFrame(rows, "unique_id string, status string, message string")
    assert checks.test_report(df).first().report == "2 of 3 tests failed in last run:\nrel - No message\nunique_id - Got 2 results"
    assert checks.test_report(df.where("status = 'pass'")).first().report == "All 1 tests passed in last run."


def test_log_without_matches(spark):
    row = checks.mine_test_logs(spark.createDataFrame([("nothing",), (None,)], "log string")).first()
    assert (row.summary, row.status, row.notable) == ("<NO SUMMARY LOG FOUND/>", "<NO STATUS LOG FOUND/>", [])


def test_grouped_export(spark, tmp_path):
    df = spark.createDataFrame([("Leo", "blue", ""), ("Raph", "red", "sai"), ("Leo", "blue", "katana"), (None, "x", "y")], "name string, mask string, weapon string")
    named = exports.with_file(df, "name", "turtles_{name}")
    exports.export_groups(named, str(tmp_path / "g"))
    got = exports.written_manifest(spark, str(tmp_path / "g")).groupBy("file").agg(F.sum("rows").alias("rows"))
    assertDataFrameEqual(got, exports.manifest(named))
    assert {r.file: r.rows for r in got.collect()} == {"turtles_Leo.csv": 2, "turtles_Raph.csv": 1}
    back = spark.read.option("header", True).csv(str(tmp_path / "g"))
    assert set(back.columns) == {"name", "mask", "weapon", "_file"}


def test_a_file_for_each_group(spark, tmp_path):
    rows = [("Leo", i, 'a "b",\nc' if i == 3 else "ü") for i in range(500)] + [("x/y 5%: =1", 1, ""), ("Raph", 2, None), (None, 3, "z")]
    df = spark.createDataFrame(rows, ["name", "n, of it", "text"]).repartition(4)
    for salt in (1, 5):  # the second export takes the place of the first
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", salt == 1)  # so few rows would share a task
        told = {r.file: (r.parts, r.bytes) for r in exports.export_files(exports.with_file(df, "name", "of_{name}"), str(tmp_path / "g"), salt=salt).collect()}
        made = {p.name: p for p in (tmp_path / "g").iterdir() if p.is_file()}
        assert set(made) == {"of_Leo.csv", "of_x%2Fy 5%25%3A =1.csv", "of_Raph.csv"} == set(told)
        assert {n: p.stat().st_size for n, p in made.items()} == {n: size for n, (_, size) in told.items()}
        assert (told["of_Leo.csv"][0] > 1) == (salt > 1)
        back = spark.read.option("header", True).option("multiLine", True).option("escape", "\\").csv(str(tmp_path / "g"))
        assert back.columns == ["name", "n, of it", "text"]
        assert sorted((r[0], int(r[1])) for r in back.collect()) == sorted((a, n) for a, n, _ in rows if a)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [p.name for p in tmp_path.iterdir()] == ["g"]
    assert exports.export_files(exports.with_file(df.where("name = 'none'"), "name"), str(tmp_path / "g")).count() == 0
    assert list((tmp_path / "g").iterdir()) == []


def test_single_and_text_export(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b,c", "")], "x string, y string")
    exports.export_one(df, str(tmp_path / "one"), sep="|")
    files = list((tmp_path / "one").glob("*.csv"))
    assert len(files) == 1 and sorted(files[0].read_text().splitlines()) == ["a|", "b,c|", "x|y"]
    exports.export_text(df.select("x"), str(tmp_path / "text"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "text")).collect()) == ["a", "b,c"]


def test_file_names(spark):
    df = spark.createDataFrame([("A/b", 1)], "x string, y long")
    name = lambda *a, **k: df.select(c.file_name(*a, **k)).first()[0]
    assert name(["x", "y"]) == "A/b_1.csv"
    assert name(["x"], "r_{x}", {"x": F.lower}, datetime(2024, 3, 5), "txt") == "r_a/b_20240305.txt"


def test_landings_and_seeds(spark, tmp_path):
    (tmp_path / "posts").mkdir()
    (tmp_path / "posts" / "p.json").write_text('[{"userId": 1, "id": 1, "title": "t", "body": "b"}, {"userId": 1, "id": 2, "title": "u", "body": "c"}]')
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "l.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert scans.read_resources(spark, str(tmp_path), {"posts": None})["posts"].count() == 2
    assert scans.read_json_landing(spark, str(tmp_path / "lines"), "a long", array=False).count() == 2
    seed = tmp_path / "seed.csv"
    seed.write_text('date_key,holiday\n2010-01-18,"Birthday of Martin Luther King, Jr."\n2010-02-15,Washington’s Birthday\n')
    assert [r.holiday for r in scans.read_seed(spark, str(seed), "date_key date, holiday string").collect()] == ["Birthday of Martin Luther King, Jr.", "Washington’s Birthday"]


def test_new_files_and_cursor(spark, tmp_path):
    for n in (1, 2, 3):
        (tmp_path / f"file{n}.csv").write_text("x")
    first = scans.new_files(spark, str(tmp_path))
    keys = [r.key for r in first.collect()]
    assert len(keys) == 3 and keys == sorted(keys)
    cursor = scans.next_cursor(first)
    assert scans.new_files(spark, str(tmp_path), cursor).count() == 0
    assert scans.next_cursor(scans.new_files(spark, str(tmp_path), cursor), cursor) == cursor
    assert scans.new_files(spark, str(tmp_path), keys[0]).count() == 2


def test_registered_tables_and_sql(spark, sf_dir):
    assert scans.register_tables(spark, sf_dir, "shop", ["nation", "region"]) == ["landed_shop__nation", "landed_shop__region"]
    assert spark.sql("SELECT count(*) AS n FROM landed_shop__nation").first().n == 25
    assert scans.jdbc_url("redshift", "host/db") == "jdbc:redshift://host/db"
    with pytest.raises(ValueError, match="oracle"):
        scans.jdbc_url("oracle")
    scans.import_as(scans.source(spark, sf_dir, "region"), "r")
    assert spark.table("r").count() == 5


def test_jdbc_scan(spark, sf_dir):
    """Against the embedded database that Spark brings along."""
    url = "jdbc:derby:memory:brindle;create=true"
    scans.source(spark, sf_dir, "nation").write.jdbc(url, "nation", "overwrite")
    some = scans.read_jdbc(spark, 'SELECT "n_name", "n_regionkey" FROM nation WHERE "n_nationkey" < 5', url)
    assert some.columns == ["n_name", "n_regionkey"] and some.count() == 5
    cut = scans.read_jdbc(spark, 'SELECT "n_nationkey" AS k FROM nation', url, partitionColumn="K", lowerBound=0, upperBound=25, numPartitions=3)
    assert cut.rdd.getNumPartitions() == 3 and cut.distinct().count() == 25


def test_etl_and_summary(spark):
    records, summary = models.etl(spark, "test")
    assert [tuple(r) for r in records.orderBy("id").collect()] == [(n, f"RAW_RECORD_{n}", "test", True) for n in (1, 2, 3)]
    assert "3 records" in summary and "successfully" in summary


def test_report_job(spark, sf_dir, tmp_path):
    scans.import_as(scans.source(spark, sf_dir, "customer"), "c")
    rows = spark.sql("SELECT c_name, c_mktsegment FROM c")
    by_segment = models.run_report(rows, str(tmp_path / "segments"), {"c_name": "name"}, "{c_mktsegment}", ("c_mktsegment",), datetime(2024, 1, 1))
    assert exports.written_manifest(spark, by_segment).agg(F.sum("rows")).first()[0] == 150
    assert spark.read.option("header", True).csv(models.run_report(rows, str(tmp_path / "all"))).count() == 150


def test_full_job(spark, sf_dir, tmp_path):
    orders = scans.source(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("created_at"))
    customers = spark.createDataFrame([(1, "CA"), (2, "ZZ")], "id long, state string")
    now = datetime(2024, 1, 2)
    for _ in range(2):
        out = models.full_job(spark, {"orders": orders, "customers": customers}, str(tmp_path), now, now)
        assert out.where("NOT passed").count() == 0 and out.count() == 5
    with pytest.raises(models.StepFailed):
        models.full_job(spark, {"orders": orders.union(orders), "customers": customers}, str(tmp_path), now, now)


def test_compaction(spark, sf_dir, tmp_path):
    df = scans.source(spark, sf_dir, "orders").repartition(8)
    shaping.compact(df, str(tmp_path / "c"), 2)
    assert len(list((tmp_path / "c").glob("*.parquet"))) == 2


def test_maintenance_job(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    spark.range(50).repartition(5).write.mode("overwrite").saveAsTable("staging.wide")
    stats = spark.createDataFrame([("staging", "wide", 5), ("staging", "gone", 9), ("staging", "clean", 0), ("other", "x", 9)], "schemaname string, relname string, n_dead long")
    candidates = shaping.maintenance_candidates(stats, ["staging"])
    assert [r.command for r in candidates.collect()][1] == "ANALYZE TABLE `staging`.`wide` COMPUTE STATISTICS;"
    assert shaping.maintain(candidates, str(tmp_path)) == ["`staging`.`wide`"]
    for _ in range(2):  # the table itself is mended, and can be again
        files = spark.table("staging.wide").inputFiles()
        assert len(files) == 1 and str(tmp_path) in files[0] and spark.table("staging.wide").count() == 50
        assert "50 rows" in {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED staging.wide").collect()}["Statistics"]
        shaping.maintain(candidates, str(tmp_path))


def test_maintenance_writes_files_by_size(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(9).write.mode("overwrite").saveAsTable("staging.large")
    candidates = spark.createDataFrame([("staging", "large")], "schemaname string, relname string")
    size = shaping.stored_bytes(spark.table("staging.large"))
    assert size == sum(Path(urlparse(f).path).stat().st_size for f in spark.table("staging.large").inputFiles())
    shaping.maintain(candidates, str(tmp_path), target=size // 3 + 1)
    assert len(spark.table("staging.large").inputFiles()) == 3 and spark.table("staging.large").count() == 20000
    spark.sql("TRUNCATE TABLE staging.large")
    shaping.maintain(candidates, str(tmp_path))
    assert spark.table("staging.large").count() == 0


def test_maintenance_leaves_partitioned_tables_in_place(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    spark.range(10).withColumn("p", F.col("id") % 2).write.mode("overwrite").partitionBy("p").saveAsTable("staging.parts")
    candidates = spark.createDataFrame([("staging", "parts")], "schemaname string, relname string")
    before = sorted(spark.table("staging.parts").inputFiles())
    assert shaping.maintain(candidates, str(tmp_path)) == ["`staging`.`parts`"] and sorted(spark.table("staging.parts").inputFiles()) == before


def test_results_document(spark, tmp_path):
    (tmp_path / "run_results.json").write_text('{"results": [{"unique_id": "test.dw.nn_x.1", "status": "fail", "message": "Got 1 result, configured"}, {"unique_id": "test.dw.u.2", "status": "pass", "message": null}]}')
    report = checks.test_report(scans.read_test_results(spark, str(tmp_path))).first()
    assert (report.total, report.failed) == (2, 1) and report.report.endswith("nn_x - Got 1 result")


def test_model_unit_test(spark):
    actual = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "id long, s string, other long")
    right = spark.createDataFrame([(2, "b"), (1, "a")], "id long, s string")
    assert checks.matches(actual, right).first().passed
    assert checks.matches(actual, right.where("id = 1")).first().failures == 1
