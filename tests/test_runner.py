import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowspark.catalog import flows
from flowspark.catalog.derived import table
from flowspark.catalog.flows import step
from flowspark.plans.runner import FlowError, active_steps, bind_sql, dry_run, run_flow, write_step


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_binding_replaces_tables_and_keeps_parameters_typed():
    text, args = bind_sql("SELECT a FROM ${T} WHERE d >= $[DAY]", {"T": "v1"}, {"DAY": dt.date(2020, 1, 1), "X": 1})
    assert text == "SELECT a FROM v1 WHERE d >= :DAY" and args == {"DAY": dt.date(2020, 1, 1)}


def test_unbound_name_is_an_error(spark, sf):
    with pytest.raises(FlowError, match="ORDERS"):
        run_flow(spark, flows.TOTALS, {})


def test_inactive_parent_is_an_error_before_anything_runs():
    flow = {"name": "F", "steps": [step("A", [], 1, "SELECT 1 AS x", active=False), step("B", ["A"], 2, "SELECT x FROM A")]}
    with pytest.raises(FlowError, match="inactive"):
        active_steps(flow)


def test_parents_come_first_whatever_the_order_numbers():
    flow = {"name": "F", "steps": [step("B", ["A"], 1, "SELECT x FROM A"), step("A", [], 2, "SELECT 1 AS x")]}
    assert [s["name"] for s in active_steps(flow)] == ["A", "B"]


def test_order_decides_between_steps_without_parents():
    steps = [step("LATE", [], 3, "SELECT 1 AS x"), step("CHILD", ["TOP"], 2, "SELECT x FROM TOP"), step("TOP", [], 1, "SELECT 1 AS x")]
    assert [s["name"] for s in active_steps({"name": "F", "steps": steps})] == ["TOP", "CHILD", "LATE"]


def test_a_cycle_is_an_error():
    steps = [step("A", ["B"], 1, "SELECT 1 AS x"), step("B", ["A"], 2, "SELECT 1 AS x")]
    with pytest.raises(FlowError, match="depend"):
        active_steps({"name": "F", "steps": steps})


def test_views_do_not_outlive_the_run(spark, sf):
    spark.range(3).createOrReplaceTempView("SEEN_LATELY")
    df = flows.flow_inactive_customers(spark, sf)
    assert df.count() > 0
    assert spark.table("SEEN_LATELY").columns == ["id"]
    names = {t.name.lower() for t in spark.catalog.listTables()}
    assert "dormant" not in names and not any(n.startswith("bound_") for n in names)
    spark.catalog.dropTempView("SEEN_LATELY")


def test_filter_and_columns_reach_the_scan_through_the_chain(spark, sf):
    df = flows.flow_inactive_customers(spark, sf).filter("c_custkey < 50").select("c_custkey")
    text = plan(df)
    assert "LessThan(c_custkey,50)" in text
    assert "ReadSchema: struct<c_custkey:bigint>" in text


def test_cache_keeps_only_views_read_more_than_once(spark, sf):
    steps = [
        step("A", [], 1, "SELECT o_orderkey, o_custkey FROM ${O}"),
        step("B", ["A"], 2, "SELECT o_orderkey FROM A"),
        step("C", ["A", "B"], 3, "SELECT a.o_custkey FROM A a LEFT SEMI JOIN B b ON a.o_orderkey = b.o_orderkey"),
    ]
    run = run_flow(spark, {"name": "F", "steps": steps}, {"O": table(spark, sf, "orders")}, cache=True)
    assert len(run.cached) == 1 and run["C"].count() == table(spark, sf, "orders").count()
    run.release()


def test_replace_and_append(spark, sf, folder):
    tables, cut = {"ORDERS": table(spark, sf, "orders")}, {"CUT": dt.date(1998, 1, 1)}
    for _ in range(2):
        run = run_flow(spark, flows.TWO_WRITES, tables, cut, sink_folder=folder, write=True)
    assert [w[2] for w in run.written] == ["REPLACE", "APPEND"]
    assert spark.read.parquet(f"{folder}/PERIODS").count() == table(spark, sf, "orders").count()


def test_a_rerun_leaves_the_same_rows(spark, sf, folder):
    tables, cut = {"ORDERS": table(spark, sf, "orders")}, {"CUT": dt.date(1998, 1, 1)}
    n = table(spark, sf, "orders").count()
    late = {**flows.TWO_WRITES, "steps": [s for s in flows.TWO_WRITES["steps"] if s["name"] != "SAVE_EARLY"]}
    n_late = table(spark, sf, "orders").filter("o_orderdate >= DATE'1998-01-01'").count()
    for where in (folder, None):  # folder, and catalog table
        read = (lambda: spark.read.parquet(f"{folder}/PERIODS")) if where else (lambda: spark.table("PERIODS"))
        try:
            for _ in range(2):
                run_flow(spark, flows.TWO_WRITES, tables, cut, sink_folder=where, write=True, run_id="r1")
            assert read().count() == n
            for _ in range(2):
                run_flow(spark, late, tables, cut, sink_folder=where, write=True, run_id="r2")
            assert read().count() == n + n_late
            assert {r[0] for r in read().select("run_id").distinct().collect()} == {"r1.SAVE_EARLY", "r1.SAVE_LATE", "r2.SAVE_LATE"}
        finally:
            if not where:
                spark.sql("DROP TABLE IF EXISTS PERIODS")


def test_a_step_may_read_its_own_target(spark, folder):
    spark.range(5).write.parquet(f"{folder}/T")
    doubled = spark.read.parquet(f"{folder}/T").selectExpr("id * 2 AS id")
    write_step(doubled, "T", "REPLACE", folder)
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/T").collect()) == [0, 2, 4, 6, 8]
    with pytest.raises(Exception, match="no such id"):
        write_step(spark.read.parquet(f"{folder}/T").selectExpr("assert_true(id < 8, 'no such id') IS NULL AS id"), "T", "REPLACE", folder)
    assert spark.read.parquet(f"{folder}/T").count() == 5


def test_target_variable(spark, sf, folder):
    tables = {"PEOPLE": table(spark, sf, "customer"), "SALES": table(spark, sf, "orders")}
    params = {"AS_OF": flows.REFERENCE_DATE}
    run = run_flow(spark, flows.INACTIVE, tables, params, targets={"TARGET": "idle"}, sink_folder=folder, write=True)
    assert spark.read.parquet(f"{folder}/idle").count() == run["KEEP_DORMANT"].count()
    with pytest.raises(FlowError, match="TARGET"):
        run_flow(spark, flows.INACTIVE, tables, params, sink_folder=folder, write=True)


def test_dry_run_reports_without_a_job(spark):
    schema = "o_custkey BIGINT, o_totalprice DOUBLE"
    assert dry_run(spark, flows.TOTALS, {"ORDERS": schema}) == []
    bad = {"name": "F", "steps": [
        step("A", [], 1, "SELECT nothing FROM ${ORDERS}"),
        step("B", [], 1, "SELEC 1"),
        step("C", [], 1, "SELECT no_such_function(1) AS x"),
        step("D", ["A"], 2, "SELECT * FROM A"),
    ]}
    found = dict(dry_run(spark, bad, {"ORDERS": schema}))
    assert set(found) == {"A", "B", "C", "D"}
    assert found["A"].startswith("UNRESOLVED_COLUMN") and found["C"] == "UNRESOLVED_ROUTINE"


def test_having_setting_is_restored(spark, sf):
    before = spark.conf.get("spark.sql.legacy.parser.havingWithoutGroupByAsWhere")
    assert flows.flow_statement(spark, sf).filter(F.col("mark") != "1").count() == 0
    assert spark.conf.get("spark.sql.legacy.parser.havingWithoutGroupByAsWhere") == before
