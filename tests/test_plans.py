"""What the optimizer makes of the queries."""

import re

import pytest

import __spark_entry__ as entry
from lakemart import catalog, standins
from lakemart.plans import calendar as cal
from lakemart.plans import facts, metrics

NAMES = sorted(catalog.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_pairwise_join_and_no_python(spark, small, name):
    text = plan(entry.queries()[name](spark, small))
    assert not re.search("NestedLoopJoin|CartesianProduct", text)
    assert not re.search("BatchEvalPython|ArrowEvalPython|InPandas|InArrow", text)


def test_rank_is_cut_before_the_shuffle(spark, small):
    text = plan(entry.queries()["latest_by_composite_key"](spark, small))
    final, partial = text.index(", Final"), text.index(", Partial")
    assert final < text.index("Exchange") < partial


def test_history_shuffles_rows_once(spark, small):
    """Other shuffles come behind an aggregate: one row per key and slice. Equal ones are made once when it runs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()["scd2_history"](spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = re.findall(r"Exchange hashpartitioning[^\n]*\n(?:[^\n]*Project[^\n]*\n)*\W*(\w+)", text)
    assert {node for node in below if not re.search("Aggregate|Window", node)} == {"FileScan"}, text


@pytest.mark.parametrize("build, column", [("member_months", "l_partkey"), ("activity", "l_suppkey")])
def test_lines_are_shuffled_once_for_days_months_and_keys(spark, small, build, column):
    """By the digest of their key; what follows groups and joins where the lines lie."""
    text = plan(getattr(standins, build)(spark, small))
    shuffles = re.findall(r"Exchange hashpartitioning\([^\n]*", text)
    lines = [s for s in shuffles if column in s and "REPARTITION" in s]
    again = [s for s in shuffles if s not in lines and re.search("l_partkey|l_suppkey|_key", s) and "md5" not in s]
    assert len(lines) == 1 and not [s for s in again if "day" in s or "month" in s], shuffles


def test_months_are_gathered_before_keys_are_made(spark, small):
    for cost in (True, False):
        if cost:
            df = facts.fct_cost_monthly(*standins.cost_inputs(spark, small), by_month=True)
        else:
            starts = cal.month_starts(standins.calendar(spark, small))
            team = metrics.teambase_member_revenue(standins.team_members(spark, small))
            df = facts.fct_revenue_monthly(standins.dim_project(spark, small), starts, team, by_month=True)
        text = plan(df)
        assert "REBALANCE" in text and "_monthly_key" in text[: text.index("REBALANCE")]
        assert "_monthly_key" not in text[text.rindex("REBALANCE") :]


def test_merge_pushes_each_sources_watermark_into_its_scan(spark, small):
    text = plan(entry.queries()["merge_upsert"](spark, small))
    assert len(re.findall(r"PushedFilters: \[[^\]]*GreaterThan\(ts,", text)) >= 5


def test_reports_read_only_the_columns_they_use(spark, small):
    text = plan(entry.queries()["agg_filtered"](spark, small))
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_linestatus:string,l_shipdate", text)


def test_filter_reaches_the_scan(spark, small):
    text = plan(entry.queries()["dim_date"](spark, small))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text


def test_checks_of_a_table_share_one_scan(spark, small):
    from lakemart.operators import quality
    from lakemart.standins import table

    lines = table(spark, small, "lineitem")
    assert plan(quality.not_null(lines, "lineitem", lines.columns)).count("FileScan") == 1


@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith("card_")])
def test_cards_read_stored_reports(spark, small, name):
    df = entry.queries()[name](spark, small)
    files = " ".join(df.inputFiles())
    assert "/mart/rpt_" in files and "lineitem" not in files


def test_merge_reads_each_source_once(spark, small):
    """Five sources in the landing and the stored table."""
    assert plan(entry.queries()["merge_upsert"](spark, small)).count("FileScan") == 6


def test_changed_tables_are_read_again(spark, small, tmp_path):
    import shutil

    folder = tmp_path / "sf"
    shutil.copytree(small, folder)
    count = lambda: entry.queries()["load_append"](spark, str(folder)).count()
    before = count()
    (folder / "customer.parquet").chmod(0o644)
    folder.chmod(0o755)
    rows = spark.read.parquet(f"{small}/customer.parquet").limit(10).toPandas()
    rows.to_parquet(folder / "customer.parquet", index=False)
    assert before > count() == 20
