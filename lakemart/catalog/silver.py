"""Keyed tables, merges and history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakemart import operators as op
from lakemart import standins as si
from lakemart.catalog.ctes import with_views
from lakemart.functions import date_key, money, name_parts, source_of, sum_where
from lakemart.operators.monitor import within_retention
from lakemart.plans.dims import latest_contracts
from lakemart.plans.silver import SilverModel, refresh_silver
from lakemart.session import new_table_path
from lakemart.sources.store import HistoryTable

KEYS = ["id"]


def silver_current(spark, sf_dir):
    return op.current_rows(si.event_sources(spark, sf_dir), KEYS, ["event_id"])


def _stored(spark, sources, *drop):
    """The keyed table as a first load left it."""
    path = new_table_path(spark, "keyed")
    op.current_rows(sources, KEYS, ["event_id"]).drop(*drop).write.parquet(path)
    return spark.read.parquet(path)


def _early(spark, sf_dir):
    return {s: si.before_cut(df) for s, df in si.event_sources(spark, sf_dir).items()}


def merge_upsert(spark, sf_dir):
    """Deleted rows stay; late rows and rows without a load id are not taken."""
    landing = op.union_sources(si.uneven_landing(spark, sf_dir))
    return op.merge_incremental(_stored(spark, _early(spark, sf_dir)), landing, KEYS, ["event_id"])


def merge_append_new_columns(spark, sf_dir):
    """The target has no ``props`` yet, the batch brings it."""
    landing = op.union_sources(si.event_sources(spark, sf_dir))
    return op.merge_incremental(_stored(spark, _early(spark, sf_dir), "props"), landing, KEYS, ["event_id"])


def merge_global_watermark(spark, sf_dir):
    """One watermark for all sources: clicks are late and lie before the newest batch of the others."""
    sources = si.event_sources(spark, sf_dir)
    early = {s: df if s != "click" else si.before_cut(df) for s, df in sources.items()}
    landing = op.union_sources(sources)
    return op.merge_incremental(_stored(spark, early), landing, KEYS, ["event_id"], watermark="global")


MODELS = [
    SilverModel("party", "party", ["shop", "vendor"]),
    SilverModel("purchase", "orders", ["shop"], tie_breakers=["note"]),
]


def silver_models(spark, sf_dir):
    """Two declared models: parties of two sources under one key, and orders kept per customer."""
    loaded = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("_load_id")
    party = {
        ("shop", "party"): ("customer", "c_custkey", "c_name"),
        ("vendor", "party"): ("supplier", "s_suppkey", "s_name"),
    }
    staging = {
        at: si.table(spark, sf_dir, t).select(F.col(k).alias("id"), F.col(n).alias("note"), loaded)
        for at, (t, k, n) in party.items()
    }
    staging["shop", "orders"] = si.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("note"),
        F.col("o_orderdate").alias("_load_id"),
    )
    tables = refresh_silver(spark, MODELS, staging, new_table_path(spark, "silver"))
    named = [df.select(F.lit(name).alias("model"), "id", "_source", "note") for name, df in tables.items()]
    return named[0].unionByName(named[1])


def scd2_history(spark, sf_dir):
    events = si.table(spark, sf_dir, "events")
    return op.build_history(events, ["user_id"], ["event_type"], "ts", ["event_id"])


def scd2_apply_batch(spark, sf_dir):
    """The early events are a stored history; the later ones are applied as one batch."""
    events = si.table(spark, sf_dir, "events")
    history = HistoryTable(spark, new_table_path(spark, "history"), ["user_id"], ["event_type"], "ts", ["event_id"])
    history.apply(si.before_cut(events, "ts"))
    history.apply(si.from_cut(events, "ts"))
    return history.read()


def scd2_apply_late_batch(spark, sf_dir):
    """Events with even ids first, then those with odd ids, which lie between them."""
    events = si.table(spark, sf_dir, "events")
    history = HistoryTable(spark, new_table_path(spark, "history"), ["user_id"], ["event_type"], "ts", ["event_id"])
    for part in (0, 1):
        history.apply(events.where(F.col("event_id") % 2 == part))
    return history.read()


def scd2_timestamp(spark, sf_dir):
    """A version for every time of a user, also where the type stays the same."""
    events = si.table(spark, sf_dir, "events")
    return op.build_history(events, ["user_id"], ["event_type"], "ts", ["event_id"], strategy="timestamp")


def fact_current_dim_lookup(spark, sf_dir):
    """Early events are the fact, newer ones are inserted; each row gets its user's open version and date key."""
    events = si.table(spark, sf_dir, "events")
    rows = events.select("event_id", "user_id", money("value").alias("value"), F.col("ts").alias("created_at"))
    fact = op.insert_newer(si.before_cut(rows, "created_at"), rows, "created_at")
    history = op.build_history(events, ["user_id"], ["event_type"], "ts", ["event_id"])
    return op.lookup_current(fact, history, ["user_id"]).select(
        "event_id",
        "user_id",
        "value",
        date_key(F.to_date("created_at")).alias("created_date_key"),
        F.col("event_type").alias("current_type"),
        F.col("valid_from").alias("current_since"),
    )


def latest_by_composite_key(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = si.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return op.newest_per_key(rows, ["l_orderkey", "l_linenumber"], order)


def latest_contract(spark, sf_dir):
    return latest_contracts(si.contracts(spark, sf_dir), ["base_salary"]).select("employee", "base_salary", "modified")


def source_names(spark, sf_dir):
    """Runs per layer, subject and source, from the job's name."""
    runs = si.audit(spark, sf_dir).select(name_parts("dag_id").alias("parts"), source_of("dag_id").alias("of"))
    return runs.groupBy("parts.layer", "parts.subject", "parts.source", "of").agg(F.count(F.lit(1)).alias("runs"))


def retention_rows(spark, sf_dir):
    rows = si.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("load_date"))
    return within_retention(rows, "load_date", dt.date(2001, 8, 1), 365)


def join_path_containment(spark, sf_dir):
    """Customers are departments under region/nation/customer; nations are the units looked for."""
    text = lambda c: F.col(c).cast("string")
    nation = si.table(spark, sf_dir, "nation")
    slash = F.lit("/")
    departments = (
        si.table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.concat(
                slash, text("n_regionkey"), slash, (F.col("n_nationkey") + 5).cast("string"), slash, text("c_custkey"), slash
            ).alias("parent_path"),
        )
    )
    units = nation.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit_name"))
    return op.join_path_contains(departments, units, "parent_path", "unit_id").select(
        "c_custkey", "parent_path", "unit_id", "unit_name"
    )


def unit_ancestors(spark, sf_dir):
    """Customers under nations under regions, and parts under the part of half their number: only parents are given."""

    def nodes(table, kind, key, above, parent):
        name = F.concat(F.lit(kind), F.col(key).cast("string")).alias("unit")
        return si.table(spark, sf_dir, table).select(name, F.concat(F.lit(above), parent.cast("string")).alias("parent"))

    half = F.floor(F.col("p_partkey") / 2)
    units = nodes("customer", "c", "c_custkey", "n", F.col("c_nationkey"))
    units = units.unionByName(nodes("nation", "n", "n_nationkey", "r", F.col("n_regionkey")))
    units = units.unionByName(nodes("region", "r", "r_regionkey", "r", F.lit(None)))
    units = units.unionByName(nodes("part", "p", "p_partkey", "p", F.when(half > 0, half)))
    return op.ancestors(units, "unit", "parent")


def agg_filtered(spark, sf_dir):
    rows = si.table(spark, sf_dir, "lineitem")
    price = money("l_extendedprice")
    flag = F.col("l_returnflag")
    return rows.groupBy(F.year("l_shipdate").alias("year")).agg(
        sum_where(price, flag == "R").alias("returned"),
        sum_where(price, flag.isin("A", "N")).alias("kept"),
        F.count_if((flag == "R") | (F.col("l_linestatus") == "O")).alias("open_or_returned"),
        F.count(F.lit(1)).alias("lines"),
    )


QUERIES = {
    "silver_current": silver_current,
    "merge_upsert": merge_upsert,
    "merge_append_new_columns": merge_append_new_columns,
    "merge_global_watermark": merge_global_watermark,
    "silver_models": silver_models,
    "scd2_history": scd2_history,
    "scd2_apply_batch": scd2_apply_batch,
    "scd2_apply_late_batch": scd2_apply_late_batch,
    "scd2_timestamp": scd2_timestamp,
    "fact_current_dim_lookup": fact_current_dim_lookup,
    "latest_by_composite_key": latest_by_composite_key,
    "latest_contract": latest_contract,
    "source_names": source_names,
    "retention_rows": retention_rows,
    "join_path_containment": join_path_containment,
    "unit_ancestors": unit_ancestors,
    "agg_filtered": agg_filtered,
}

_NEWEST = """
SELECT event_type AS _source, user_id AS id, event_id, value, {props} AS props, ts AS _load_id FROM events {where}
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1"""
_VERSIONS = "SELECT user_id, event_type, valid_from, valid_to, valid_to IS NULL AS is_current FROM version"

ORACLE = {
    "silver_current": _NEWEST.format(props="props", where=""),
    "merge_upsert": _NEWEST.format(props="props", where="WHERE user_id % 10 > 2 OR ts < TIMESTAMP '2024-01-20'"),
    "merge_append_new_columns": _NEWEST.format(
        props="CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN props END", where=""
    ),
    "merge_global_watermark": _NEWEST.format(
        props="props",
        where="""WHERE event_type <> 'click' OR ts < TIMESTAMP '2024-01-20'
                 OR ts > (SELECT max(ts) FROM events WHERE event_type <> 'click')""",
    ),
    "silver_models": """
        SELECT 'party' AS model, c_custkey AS id, 'shop' AS _source, c_name AS note FROM customer
        UNION ALL SELECT 'party', s_suppkey, 'vendor', s_name FROM supplier
        UNION ALL SELECT 'purchase', o_custkey, 'shop',
                         max_by(o_orderpriority || ' ' || o_orderkey, (o_orderdate, o_orderpriority || ' ' || o_orderkey))
                  FROM orders GROUP BY o_custkey""",
    "scd2_history": with_views(_VERSIONS),
    "scd2_apply_batch": with_views(_VERSIONS),
    "scd2_apply_late_batch": with_views(_VERSIONS),
    "scd2_timestamp": """
        SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
        FROM (SELECT user_id, ts, max_by(event_type, event_id) AS event_type FROM events GROUP BY ALL)
        WINDOW w AS (PARTITION BY user_id ORDER BY ts)""",
    "fact_current_dim_lookup": with_views("""
        SELECT event_id, e.user_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
               CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS created_date_key,
               v.event_type AS current_type, v.valid_from AS current_since
        FROM events e LEFT JOIN version v ON e.user_id = v.user_id AND v.valid_to IS NULL"""),
    "latest_by_composite_key": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                                            l_extendedprice DESC) = 1""",
    "latest_contract": with_views(
        "SELECT sup AS employee, CAST(pay * 0.01 AS DOUBLE) AS base_salary, modified FROM contract"
    ),
    "source_names": with_views("""
        SELECT split_part(dag_id, '__', 1) AS layer, split_part(dag_id, '__', 2) AS subject,
               split_part(dag_id, '__', 3) AS source, split_part(dag_id, '__', 3) AS of, count(*) AS runs
        FROM run GROUP BY ALL"""),
    "retention_rows": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS load_date FROM orders
        WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 365""",
    "join_path_containment": """
        WITH dept AS (SELECT c_custkey, '/' || n.n_regionkey || '/' || (n.n_nationkey + 5) || '/' || c_custkey || '/' AS parent_path
                      FROM customer JOIN nation n ON c_nationkey = n.n_nationkey)
        SELECT c_custkey, parent_path, u.n_nationkey AS unit_id, u.n_name AS unit_name
        FROM dept LEFT JOIN nation u ON parent_path LIKE '%/' || u.n_nationkey || '/%'""",
    "unit_ancestors": """
        WITH RECURSIVE unit AS (
            SELECT 'c' || c_custkey AS unit, 'n' || c_nationkey AS parent FROM customer
            UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
            UNION ALL SELECT 'p' || p_partkey, 'p' || (p_partkey // 2) FROM part WHERE p_partkey > 1
        ), up AS (
            SELECT unit, parent AS ancestor, 1 AS distance FROM unit
            UNION ALL SELECT up.unit, unit.parent, distance + 1 FROM up JOIN unit ON unit.unit = up.ancestor
        )
        SELECT unit, ancestor, distance FROM up""",
    "agg_filtered": """
        SELECT year(l_shipdate) AS year,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag IN ('A', 'N')) AS DOUBLE) AS kept,
               count(*) FILTER (l_returnflag = 'R' OR l_linestatus = 'O') AS open_or_returned, count(*) AS lines
        FROM lineitem GROUP BY 1""",
}
