"""Loads, dated partitions, staging, seeds and the run log: each query writes and reads back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemart import operators as op
from lakemart import standins as si
from lakemart.catalog.ctes import with_views
from lakemart.catalog.watch import freshness_check
from lakemart.functions import money
from lakemart.operators.monitor import load_summary as summarize
from lakemart.session import new_table_path
from lakemart.sources import bronze, load, meta, seed, staging, tables
from lakemart.sources.store import KeyedTable
from lakemart.streaming import intake

COUNTED = ("orders", "customer", "supplier", "part")


def load_full(spark, sf_dir):
    """Loaded twice; the second run replaces the first."""
    path = new_table_path(spark, "orders")
    orders = si.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    load.load(orders.where(F.col("o_orderstatus") == "F"), path, "full")
    load.load(orders, path, "full")
    return load.read_target(spark, path)


def load_append(spark, sf_dir):
    """Loaded twice; every row is there twice."""
    path = new_table_path(spark, "customer")
    rows = si.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    load.load(rows, path, "append")
    load.load(rows, path, "append")
    return load.read_target(spark, path)


def load_incremental_cursor(spark, sf_dir):
    """First run over the early events, second over all of them; the row at the boundary comes once."""
    path, state = new_table_path(spark, "events"), new_table_path(spark, "state")
    events = si.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    shared = {"table": "events", "cursor": "ts", "state": state}
    load.load(si.before_cut(events, "ts"), path, "incremental", run_id="1", **shared)
    load.load(events, path, "incremental", run_id="2", **shared)
    return load.read_target(spark, path)


def load_incremental_boundary(spark, sf_dir):
    """Days as the cursor: new rows of the newest day are taken, loaded ones are not, also where nothing newer comes."""
    path, state = new_table_path(spark, "events"), new_table_path(spark, "state")
    events = si.table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    early = si.before_cut(events.withColumn("at", F.col("day").cast("timestamp_ntz")), "at").drop("at")
    third = F.col("event_id") % 3
    shared = {"table": "events", "cursor": "day", "state": state, "identity": ["event_id", "day"]}
    load.load(early.where(third == 0), path, "incremental", run_id="1", **shared)
    load.load(early.where(third < 2), path, "incremental", run_id="2", **shared)
    load.load(early.where(third < 2), path, "incremental", run_id="3", **shared)
    load.load(events.withColumn("seen_late", third == 2), path, "incremental", run_id="4", **shared)
    return load.read_target(spark, path)


def load_initial_value(spark, sf_dir):
    """Tables new to a source that was loaded before, with a configured start in either way of writing days."""
    state, events = new_table_path(spark, "state"), si.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    shared = {"cursor": "ts", "state": state, "run_id": "1"}
    load.load(events.where(F.col("event_type") == "view"), new_table_path(spark, "a"), "incremental", table="a", **shared)
    out = []
    for kind, start in (("click", "1/20/2024"), ("purchase", "2024-01-25 12:00:00")):
        path = new_table_path(spark, kind)
        rows = events.where(F.col("event_type") == kind)
        load.load(rows, path, "incremental", table=kind, initial_value=start, **shared)
        out.append(load.read_target(spark, path))
    return out[0].unionByName(out[1])


def load_row_counts(spark, sf_dir):
    tables = {name: si.table(spark, sf_dir, name) for name in COUNTED}
    counts = bronze.write_counted(tables, new_table_path(spark, "counted"))
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


def _event_days(spark, sf_dir):
    return si.table(spark, sf_dir, "events").withColumn("load_date", F.to_date("ts"))


def bronze_daily_partition(spark, sf_dir):
    """All days landed, then the days from the cut on landed again with purchases only."""
    path = new_table_path(spark, "events")
    days = _event_days(spark, sf_dir)
    bronze.write_days(days, path)
    bronze.write_days(si.from_cut(days, "ts").where(F.col("event_type") == "purchase"), path)
    return (
        spark.read.parquet(path)
        .groupBy("load_date")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(money("value")).alias("total"))
    )


def retention_apply(spark, sf_dir):
    """Days landed, then the ones past ten days dropped; the rows that are left per day."""
    path = new_table_path(spark, "events")
    bronze.write_days(_event_days(spark, sf_dir), path)
    bronze.purge(spark, {"events": path}, dt.date(2024, 1, 31), 10)
    return spark.read.parquet(path).groupBy("load_date").agg(F.count(F.lit(1)).alias("rows"))


def bronze_run_versions(spark, sf_dir):
    """Two runs on one day; both are kept and the second is the newest."""
    path, day = new_table_path(spark, "orders"), dt.date(2001, 8, 1)
    orders = si.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    bronze.write_run(orders.where(F.col("o_orderstatus") == "F"), path, day)
    bronze.write_run(orders, path, day)
    runs = spark.read.parquet(path)
    newest = bronze.latest_snapshot(runs).select("load_date", "run_seq").distinct().withColumn("is_newest", F.lit(True))
    per_run = runs.groupBy("load_date", "run_seq").agg(F.count(F.lit(1)).alias("rows"))
    return per_run.join(F.broadcast(newest), ["load_date", "run_seq"], "left").withColumn(
        "is_newest", F.coalesce("is_newest", F.lit(False))
    )


def latest_snapshot(spark, sf_dir):
    path = new_table_path(spark, "events")
    bronze.write_days(_event_days(spark, sf_dir), path)
    return bronze.read_latest(spark, path).select("event_id", "user_id", "event_type", "ts")


def _stage(spark, sf_dir):
    root = new_table_path(spark, "bronze")
    bronze.write_days(_event_days(spark, sf_dir), f"{root}/events")
    orders = si.table(spark, sf_dir, "orders").withColumn("load_date", F.to_date(F.trunc("o_orderdate", "year")))
    bronze.write_days(orders, f"{root}/orders")
    paths = {t: f"{root}/{t}" for t in ("events", "orders", "returns")}
    return staging.stage_group(spark, paths, f"{root}/staging")


def stage_replace(spark, sf_dir):
    """Two tables with snapshots and one without."""
    return _stage(spark, sf_dir)


def load_summary(spark, sf_dir):
    return summarize(_stage(spark, sf_dir))


def stage_schema_reset(spark, sf_dir):
    """Early days lack ``props``; staging holds the old layout when a day with the new one arrives."""
    path, target = new_table_path(spark, "events"), new_table_path(spark, "staging")
    days = _event_days(spark, sf_dir)
    bronze.write_days(si.before_cut(days, "ts").drop("props"), path)
    staging.stage_table(spark, path, target)
    bronze.write_days(si.from_cut(days, "ts"), path)
    staging.stage_table(spark, path, target)
    return tables.read_table(spark, target).select("event_id", "user_id", "props")


def bronze_merged_schema(spark, sf_dir):
    """Days of both layouts read together; the column the early days lack is null there."""
    path = new_table_path(spark, "events")
    days = _event_days(spark, sf_dir)
    bronze.write_days(si.before_cut(days, "ts").drop("props"), path)
    bronze.write_days(si.from_cut(days, "ts"), path)
    merged = bronze.read_runs(spark, path)
    return merged.groupBy("load_date").agg(F.count(F.lit(1)).alias("rows"), F.count("props").alias("with_props"))


def seed_cost_category(spark, sf_dir):
    """The seed through CSV, with the fact lines and cost of each category."""
    path = new_table_path(spark, "seed")
    seed.write_seed(seed.cost_categories(spark), path)
    categories = seed.read_seed(spark, path, seed.COST_CATEGORY_SCHEMA)
    spent = (
        si.fct_cost(spark, sf_dir)
        .groupBy("cost_category_key")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("cost_actual").alias("cost_actual"))
    )
    return categories.drop("description").join(spent, "cost_category_key", "left")


def run_audit_append(spark, sf_dir):
    """Three loads that succeed and one that fails, as the run log shows them."""
    log, root = new_table_path(spark, "audit"), new_table_path(spark, "bronze")

    def work(name):
        return lambda: load.load_full(si.table(spark, sf_dir, name), f"{root}/{name}").rows

    def broken():
        raise ValueError("no such table: returns\nsecond line")

    labels = {"run_id": "1", "dag_id": "src2brz__sales__shop", "layer": "bronze", "source": "shop", "data_subject": "sales"}
    works = [({**labels, "task_id": f"load_{n}", "table_name": n}, work(n)) for n in ("orders", "customer", "part")]
    works.append(({**labels, "task_id": "load_returns", "table_name": "returns"}, broken))
    meta.audited_all(spark, log, works)
    return meta.read(spark, log, meta.AUDIT_SCHEMA).drop("started_at", "finished_at")


def meta_freshness_append(spark, sf_dir):
    """Freshness results stored in their own table."""
    path = new_table_path(spark, "freshness")
    checked = freshness_check(spark, sf_dir).withColumn("checked_at", F.lit("2024-01-31 00:00:00").cast("timestamp"))
    meta.append(checked, path, meta.FRESHNESS_SCHEMA)
    meta.append(checked, path, meta.FRESHNESS_SCHEMA)
    stored = meta.read(spark, path, meta.FRESHNESS_SCHEMA)
    return stored.groupBy("source_name", "status").agg(
        F.count(F.lit(1)).alias("checks"), F.max("hours_since_load").alias("hours")
    )


def stream_intake_upsert(spark, sf_dir):
    """Events of two deliveries picked up as a file stream and merged into a keyed table."""
    inbox, checkpoint = new_table_path(spark, "inbox"), new_table_path(spark, "checkpoint")
    store = KeyedTable(spark, new_table_path(spark, "keyed"), ["id"], ["event_id"])
    rows = si.event_rows(spark, sf_dir).withColumnRenamed("event_type", op.newest.SOURCE)
    for delivery in (si.before_cut(rows), si.from_cut(rows)):
        delivery.write.mode("append").parquet(inbox)
        intake.run_available(store, inbox, rows.schema, checkpoint)
    return store.read()


def keyed_table_refresh(spark, sf_dir):
    """Three refreshes of a stored keyed table, the last without news; one old version is kept.

    Rows that the second one lacks stay; late rows and rows without a load id are not taken.
    """
    store = KeyedTable(spark, new_table_path(spark, "keyed"), ["id"], ["event_id"])
    store.refresh(op.union_sources({s: si.before_cut(df) for s, df in si.event_sources(spark, sf_dir).items()}))
    uneven = op.union_sources(si.uneven_landing(spark, sf_dir))
    store.refresh(uneven)
    store.refresh(uneven)
    store.keep(2)
    return store.read()


def keyed_table_rebucket(spark, sf_dir):
    """Loaded with 4 buckets, written anew with 7, then refreshed by a table that asks for 5."""
    path, sources = new_table_path(spark, "keyed"), si.event_sources(spark, sf_dir)
    store = KeyedTable(spark, path, ["id"], ["event_id"], buckets=4)
    store.refresh(op.union_sources({s: si.before_cut(df) for s, df in sources.items()}))
    store.rebucket(7)
    store = KeyedTable(spark, path, ["id"], ["event_id"], buckets=5)
    store.refresh(op.union_sources(sources))
    return store.read()


def keyed_table_mixed_intake(spark, sf_dir):
    """A refresh with the late events, then streams, the second with a new checkpoint, with the early ones.

    A stored row stays where the stream brings an older one, and a user deleted at the source stays: users whose id
    divides by ten are in the refresh only, with what they had before the cut.
    """
    store = KeyedTable(spark, new_table_path(spark, "keyed"), ["id"], ["event_id"])
    rows = si.event_rows(spark, sf_dir).withColumnRenamed("event_type", op.newest.SOURCE)
    deleted = F.col("id") % 10 == 0
    store.refresh(si.from_cut(rows).where(~deleted).unionByName(si.before_cut(rows).where(deleted)))
    for part in (0, 1):
        inbox, checkpoint = new_table_path(spark, "inbox"), new_table_path(spark, "checkpoint")
        si.before_cut(rows).where(~deleted & (F.col("event_id") % 2 == part)).write.parquet(inbox)
        intake.run_available(store, inbox, rows.schema, checkpoint)
    return store.read()


def land_group(spark, sf_dir):
    """A group of tables landed on one day, with the rows each holds."""
    root, day = new_table_path(spark, "bronze"), dt.date(2001, 8, 1)
    bronze.land_group({t: si.table(spark, sf_dir, t) for t in ("orders", "customer")}, root, day)
    counts = [
        spark.read.parquet(f"{root}/{t}").groupBy("load_date").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(t))
        for t in ("orders", "customer")
    ]
    return counts[0].unionByName(counts[1])


QUERIES = {
    "load_full": load_full,
    "load_append": load_append,
    "load_incremental_cursor": load_incremental_cursor,
    "load_incremental_boundary": load_incremental_boundary,
    "load_initial_value": load_initial_value,
    "load_row_counts": load_row_counts,
    "bronze_daily_partition": bronze_daily_partition,
    "bronze_run_versions": bronze_run_versions,
    "retention_apply": retention_apply,
    "latest_snapshot": latest_snapshot,
    "bronze_merged_schema": bronze_merged_schema,
    "stage_replace": stage_replace,
    "stage_schema_reset": stage_schema_reset,
    "load_summary": load_summary,
    "seed_cost_category": seed_cost_category,
    "run_audit_append": run_audit_append,
    "meta_freshness_append": meta_freshness_append,
    "stream_intake_upsert": stream_intake_upsert,
    "keyed_table_refresh": keyed_table_refresh,
    "keyed_table_rebucket": keyed_table_rebucket,
    "keyed_table_mixed_intake": keyed_table_mixed_intake,
    "land_group": land_group,
}

_DAY = "CAST(ts AS DATE)"
_STAGED = f"""
    SELECT 'events' AS table_name, 'loaded' AS status, 1 AS files, '' AS message,
           (SELECT count(*) FROM events WHERE {_DAY} = (SELECT max({_DAY}) FROM events)) AS row_count
    UNION ALL
    SELECT 'orders', 'loaded', 1, '', (SELECT count(*) FROM orders
                                       WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders))
    UNION ALL SELECT 'returns', 'skipped', 0, 'no snapshot', 0"""

_NEWEST = """
        SELECT event_type AS _source, user_id AS id, event_id, value, props, ts AS _load_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE = {
    "load_full": "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders",
    "load_append": "SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer",
    "load_incremental_cursor": "SELECT event_id, user_id, ts FROM events",
    "load_incremental_boundary": f"""
        WITH e AS (SELECT event_id, event_type, {_DAY} AS day FROM events),
        old AS (SELECT *, (SELECT max(day) FROM e WHERE day < DATE '2024-01-20' AND event_id % 3 = 0) AS edge
                FROM e WHERE day < DATE '2024-01-20')
        SELECT event_id, event_type, day, NULL::BOOLEAN AS seen_late FROM old WHERE event_id % 3 = 0
        UNION ALL SELECT event_id, event_type, day, NULL FROM old WHERE event_id % 3 = 1 AND day >= edge
        UNION ALL SELECT event_id, event_type, day, event_id % 3 = 2 FROM old
                  WHERE event_id % 3 = 2 AND day >= (SELECT max(day) FROM old WHERE event_id % 3 < 2 AND day >= edge)
        UNION ALL SELECT event_id, event_type, day, event_id % 3 = 2 FROM e WHERE day >= DATE '2024-01-20'""",
    "load_initial_value": """
        SELECT event_id, event_type, ts FROM events
        WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-20'
           OR event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-25 12:00:00'""",
    "load_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED
    ),
    "bronze_daily_partition": f"""
        SELECT {_DAY} AS load_date, count(*) AS rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM events e WHERE ts < TIMESTAMP '2024-01-20' OR event_type = 'purchase'
           OR NOT EXISTS (FROM events p WHERE p.event_type = 'purchase' AND CAST(p.ts AS DATE) = CAST(e.ts AS DATE))
        GROUP BY 1""",
    "retention_apply": f"""
        SELECT {_DAY} AS load_date, count(*) AS rows FROM events WHERE {_DAY} >= DATE '2024-01-21' GROUP BY 1""",
    "bronze_run_versions": """
        SELECT DATE '2001-08-01' AS load_date, 0 AS run_seq, count(*) AS rows, false AS is_newest
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT DATE '2001-08-01', 1, count(*), true FROM orders""",
    "latest_snapshot": f"""
        SELECT event_id, user_id, event_type, ts FROM events WHERE {_DAY} = (SELECT max({_DAY}) FROM events)""",
    "bronze_merged_schema": f"""
        SELECT {_DAY} AS load_date, count(*) AS rows, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS with_props
        FROM events GROUP BY 1""",
    "stage_replace": _STAGED,
    "stage_schema_reset": f"""
        SELECT event_id, user_id, props FROM events WHERE {_DAY} = (SELECT max({_DAY}) FROM events)""",
    "load_summary": f"""
        SELECT CASE status WHEN 'loaded' THEN 'OK' ELSE 'SKIP' END AS result, count(*) AS tables,
               CAST(sum(files) AS BIGINT) AS files, CAST(sum(row_count) AS BIGINT) AS rows
        FROM ({_STAGED}) GROUP BY 1""",
    "seed_cost_category": with_views("""
        SELECT c.cost_category_key, cost_category, cost_group, lines, cost_actual FROM category c
        LEFT JOIN (SELECT cost_category_key, count(*) AS lines, CAST(sum(actual) AS DOUBLE) AS cost_actual
                   FROM cost GROUP BY 1) s ON c.cost_category_key = s.cost_category_key"""),
    "run_audit_append": """
        SELECT '1' AS run_id, 'src2brz__sales__shop' AS dag_id, 'load_' || t AS task_id, 'bronze' AS layer,
               'shop' AS source, 'sales' AS data_subject, t AS table_name,
               CASE WHEN n IS NULL THEN 'failed' ELSE 'success' END AS status, n AS row_count,
               CASE WHEN n IS NULL THEN 'no such table: returns' END AS error_message
        FROM (SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
              UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'returns', NULL)""",
    "meta_freshness_append": with_views("""
        SELECT s AS source_name,
               CASE WHEN round(epoch(TIMESTAMP '2024-01-31' - done_at) / 3600, 1) <= h THEN 'fresh' ELSE 'stale' END AS status,
               CAST(2 AS BIGINT) AS checks, round(epoch(TIMESTAMP '2024-01-31' - done_at) / 3600, 1) AS hours
        FROM (VALUES ('0', 24), ('1', 2), ('2', 48), ('never', 24)) t(s, h)
        LEFT JOIN (SELECT source, max(finished_at) AS done_at FROM run
                   WHERE status = 'success' AND dag_id LIKE 'src2brz%' GROUP BY source) ON s = source"""),
    "stream_intake_upsert": _NEWEST,
    "keyed_table_refresh": _NEWEST.replace(
        "FROM events", "FROM events WHERE user_id % 10 > 2 OR ts < TIMESTAMP '2024-01-20'"
    ),
    "keyed_table_rebucket": _NEWEST,
    "keyed_table_mixed_intake": _NEWEST.replace(
        "FROM events", "FROM events WHERE user_id % 10 <> 0 OR ts < TIMESTAMP '2024-01-20'"
    ),
    "land_group": """
        SELECT DATE '2001-08-01' AS load_date, count(*) AS rows, 'orders' AS table_name FROM orders
        UNION ALL SELECT DATE '2001-08-01', count(*), 'customer' FROM customer""",
}
