from logbrook.plans import catalog, events_view as view, stored
from logbrook.sources import tables as t


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_stay_in_shared_storage(spark, sf_dir):
    """No page is a local table of the driver, and the plan does not grow with the pages."""
    plan = _plan(catalog.queries()["pages_equal_lines"](spark, sf_dir))
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan and "Union" not in plan


def test_all_pages_hold_all_rows(spark, sf_dir, tmp_path):
    logs = view.log_view(spark, sf_dir)
    tables = t.LogTables(str(tmp_path))
    t.write_logs(logs, tables.logs)
    pages = stored._all_pages(spark, tables.logs, "auth-service", 40)
    want = logs.filter("service_name = 'auth-service'").select("log_uuid", "timestamp").collect()
    assert len(want) > 80 and sorted(map(tuple, pages.collect())) == sorted(map(tuple, want))
