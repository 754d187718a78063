"""Plan properties: column pruning, pushed filters, no Python in SQL paths."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_prunes_parquet_columns(spark):
    plan = _plan(E.queries()["fixed_threshold_flags"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,400.0)]" in plan


def test_weblog_fixture_join_is_equi_join(spark):
    from logloom.plans.weblog_fixture import weblog_lines
    plan = _plan(weblog_lines(spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_sql_paths_have_no_python(spark):
    for name in ["hits_by_domain", "url_parts", "word_count", "token_ngrams", "similar_paths"]:
        plan = _plan(E.queries()[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_partition_scan_prunes_at_run_time(spark):
    df = E.queries()["partition_scan"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(domain" in plan
