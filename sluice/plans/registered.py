"""Queries run by the driver: one per operator, each over whole given tables, each with the SQL
that computes the same result independently (DuckDB dialect) where SQL can express it.

Array results (failure lists) are flattened with ``array_join(..., '|')`` so both sides compare as
text; every computed column carries the same alias on both sides.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.checks import DataCheckClause
from ..operators.buckets import read_bucketed, write_bucketed
from ..operators.checks import apply_data_checks, check_report, good_rows
from ..operators.compare import frame_diff, frame_diff_by_digest
from ..operators.conform import map_column
from ..operators.latest import latest_per_key, require_fields
from ..operators.merge import MergeTarget
from ..plans.gold import build_gold, publish
from ..plans.quality import check_and_publish, check_table_from_config
from ..plans.landing import CUSTOMER_CONTRACT, apply_data_contract, load_conforming, write_customer_drops
from ..operators.contract import contract_breaches, file_schema_breaches
from ..functions.paths import path_day, path_month, path_year
from ..session import cut_lineage, shared_dir
from ..sources.config import load_data_checks
from ..sources.landing import LandingArea
from ..streaming.checks import read_checked, stream_checks, stream_session
from ..streaming.gold import upsert_gold_stream
from ..streaming.latest import upsert_latest

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CONFIG_ROOT = os.path.join(REPO_ROOT, "configs", "checks")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flat(df: DataFrame, column: str = "fail_messages") -> DataFrame:
    return df.withColumn(column, F.array_join(column, "|"))


# ---------------------------------------------------------------- row checks (O-1, O-2, O-3)

CUSTOMER_CHECKS = [
    DataCheckClause("seg IS NULL", "segment null"),
    DataCheckClause("name = ''", "name empty"),
    DataCheckClause("bal < 0", "negative balance"),
]

_CUSTOMER_DERIVED_SQL = """
WITH s AS (SELECT c_custkey, nullif(c_mktsegment, 'FURNITURE') AS seg,
                  CASE WHEN c_nationkey = 7 THEN '' ELSE c_name END AS name, c_acctbal AS bal
           FROM customer)
"""


def customer_derived(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("seg"),
        F.when(F.col("c_nationkey") == 7, F.lit("")).otherwise(F.col("c_name")).alias("name"),
        F.col("c_acctbal").alias("bal"),
    )


@register(
    "checks_bad_rows",
    _CUSTOMER_DERIVED_SQL
    + """
SELECT c_custkey, seg, name, bal,
       concat_ws('|', CASE WHEN seg IS NULL THEN 'segment null' END,
                      CASE WHEN name = '' THEN 'name empty' END,
                      CASE WHEN bal < 0 THEN 'negative balance' END) AS fail_messages
FROM s WHERE seg IS NULL OR name = '' OR bal < 0
""",
)
def checks_bad_rows(spark, sf_dir):
    return flat(apply_data_checks(customer_derived(spark, sf_dir), CUSTOMER_CHECKS))


@register(
    "checks_good_rows",
    _CUSTOMER_DERIVED_SQL
    + """
SELECT c_custkey, seg, name, bal FROM s
WHERE NOT coalesce(seg IS NULL OR name = '' OR bal < 0, false)
""",
)
def checks_good_rows(spark, sf_dir):
    return good_rows(customer_derived(spark, sf_dir), CUSTOMER_CHECKS, by="row")


@register(
    "checks_good_keys_nullsafe",
    """
WITH s AS (SELECT c_custkey, nullif(c_nationkey, 3) AS k, c_acctbal FROM customer)
SELECT * FROM s WHERE NOT EXISTS
  (SELECT 1 FROM s b WHERE b.c_acctbal < -900 AND b.k IS NOT DISTINCT FROM s.k)
""",
)
def checks_good_keys_nullsafe(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("k"), "c_acctbal"
    )
    return good_rows(c, [("c_acctbal < -900", "very negative balance")], by="key", key="k")


LINEITEM_CHECKS = [
    DataCheckClause("l_discount > 0.09", "high discount"),
    DataCheckClause("l_quantity >= 49", "bulk quantity"),
    DataCheckClause("l_returnflag = 'R' AND l_linestatus = 'O'", "returned but open"),
    DataCheckClause("l_extendedprice / l_quantity > 2000", "unit price above 2000"),
]


@register(
    "checks_report",
    """
SELECT 1 AS check_no, 'high discount' AS message, count(*) FILTER (WHERE l_discount > 0.09) AS failed_rows FROM lineitem
UNION ALL SELECT 2, 'bulk quantity', count(*) FILTER (WHERE l_quantity >= 49) FROM lineitem
UNION ALL SELECT 3, 'returned but open', count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O') FROM lineitem
UNION ALL SELECT 4, 'unit price above 2000', count(*) FILTER (WHERE l_extendedprice / l_quantity > 2000) FROM lineitem
""",
)
def checks_report(spark, sf_dir):
    return check_report(table(spark, sf_dir, "lineitem"), LINEITEM_CHECKS)


@register(
    "checks_lineitem_bad_rows",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount,
       concat_ws('|', CASE WHEN l_discount > 0.09 THEN 'high discount' END,
                      CASE WHEN l_quantity >= 49 THEN 'bulk quantity' END,
                      CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'returned but open' END,
                      CASE WHEN l_extendedprice / l_quantity > 2000 THEN 'unit price above 2000' END) AS fail_messages
FROM lineitem
WHERE l_discount > 0.09 OR l_quantity >= 49 OR (l_returnflag = 'R' AND l_linestatus = 'O')
   OR l_extendedprice / l_quantity > 2000
""",
)
def checks_lineitem_bad_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    bad = apply_data_checks(li, LINEITEM_CHECKS)
    return flat(bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "fail_messages"))


def rule_ladders(n: int) -> list[tuple[str, str]]:
    """``n`` rules for lineitem, as a configuration that grew: thresholds of every kind in no order."""
    kinds = [
        lambda j: f"l_quantity > {(j * 37) % 50}",
        lambda j: f"l_quantity <= {(j * 11) % 40} + 0.5",
        lambda j: f"l_extendedprice * (1 - l_discount) >= {(j * 7919) % 100000}",
        lambda j: f"{(j * 13) % 90} * 1000 > l_extendedprice",
        lambda j: f"l_partkey = {j + 1}",
    ]
    return [(kinds[i % len(kinds)](i // len(kinds)), f"rule {i}") for i in range(n)]


_RULES = rule_ladders(300)


@register(
    "checks_hundreds_of_rules",
    f"""
SELECT l_orderkey, l_linenumber, n_failed, md5(fail_messages) AS messages_md5
FROM (SELECT l_orderkey, l_linenumber,
             {" + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c, _ in _RULES)} AS n_failed,
             concat_ws('|', {", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, m in _RULES)}) AS fail_messages
      FROM lineitem)
WHERE n_failed > 0
""",
)
def checks_hundreds_of_rules(spark, sf_dir):
    bad = apply_data_checks(table(spark, sf_dir, "lineitem"), _RULES)
    return bad.select(
        "l_orderkey",
        "l_linenumber",
        F.size("fail_messages").alias("n_failed"),
        F.md5(F.array_join("fail_messages", "|")).alias("messages_md5"),
    )


_ORDERS_CONFIG_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       concat_ws('|', CASE WHEN o_totalprice > 400000 THEN 'Total price above 400000' END,
                      CASE WHEN o_orderstatus = 'P' THEN 'Order is still pending' END,
                      CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
                           THEN 'Urgent order still open' END) AS fail_messages
FROM orders
WHERE o_totalprice > 400000 OR o_orderstatus = 'P' OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')
"""


def _orders_checked(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@register("checks_from_config", _ORDERS_CONFIG_SQL)
def checks_from_config(spark, sf_dir):
    cfg = load_data_checks(spark, "tpch", "silver", "tpch", "orders", config_root=CONFIG_ROOT)
    return flat(apply_data_checks(_orders_checked(spark, sf_dir), cfg))


@register(
    "checks_config_good_keys",
    """
WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
     bad AS (SELECT DISTINCT o_custkey FROM s
             WHERE o_totalprice > 400000 OR o_orderstatus = 'P'
                OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'))
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.o_custkey IS NOT DISTINCT FROM s.o_custkey)
""",
)
def checks_config_good_keys(spark, sf_dir):
    cfg = load_data_checks(spark, "tpch", "silver", "tpch", "orders", config_root=CONFIG_ROOT)
    return good_rows(_orders_checked(spark, sf_dir), cfg, by="key", key="o_custkey")


@register(
    "checks_publish_split",
    """
WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
     bad AS (SELECT * FROM s WHERE o_totalprice > 400000 OR o_orderstatus = 'P'
                                 OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'))
SELECT *, 'bad' AS status FROM bad
UNION ALL
SELECT *, 'good' AS status FROM s
WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.o_custkey IS NOT DISTINCT FROM s.o_custkey)
""",
)
def checks_publish_split(spark, sf_dir):
    """The reference's check flow: config → bad rows → key-level good rows, both published."""
    out = shared_dir(spark, "checked-orders")
    good, bad = check_table_from_config(
        spark, _orders_checked(spark, sf_dir), "tpch", "silver", "tpch", "orders", config_root=CONFIG_ROOT,
        good_path=f"{out}/good", bad_path=f"{out}/bad", by="key", key="o_custkey",
    )
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return bad.select(*cols, F.lit("bad").alias("status")).unionByName(good.select(*cols, F.lit("good").alias("status")))


@register(
    "checks_observed_report",
    """
SELECT 1 AS check_no, 'high discount' AS message, count(*) FILTER (WHERE l_discount > 0.09) AS failed_rows FROM lineitem
UNION ALL SELECT 2, 'bulk quantity', count(*) FILTER (WHERE l_quantity >= 49) FROM lineitem
UNION ALL SELECT 3, 'returned but open', count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O') FROM lineitem
UNION ALL SELECT 4, 'unit price above 2000', count(*) FILTER (WHERE l_extendedprice / l_quantity > 2000) FROM lineitem
""",
)
def checks_observed_report(spark, sf_dir):
    """The check report as metrics of the check flow's own write of the bad rows."""
    out, told = shared_dir(spark, "checked-lineitem"), []
    check_and_publish(table(spark, sf_dir, "lineitem"), LINEITEM_CHECKS, good_path=f"{out}/good", bad_path=f"{out}/bad", report=told.extend)
    return spark.createDataFrame(told, "check_no int, message string, failed_rows long")


# ---------------------------------------------------------------- latest per key (O-8, O-9)


@register(
    "latest_single_key",
    """
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1
""",
)
def latest_single_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", tie_break="o_orderkey")


@register(
    "latest_composite_key",
    """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""",
)
def latest_composite_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", tie_break="event_id")


@register(
    "latest_lineitem_per_part",
    """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
                           ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC, l_orderkey DESC,
                                    l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_discount DESC, l_tax DESC) = 1
""",
)
def latest_lineitem_per_part(spark, sf_dir):
    return latest_per_key(
        table(spark, sf_dir, "lineitem"),
        "l_partkey",
        ["l_shipdate", "l_extendedprice"],
        tie_break=["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_tax"],
    )


_EVENTS_USERS_SQL = """
WITH u AS (SELECT event_id, user_id AS id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS name,
                  substr(event_type, 1, 2) AS city, ts AS effective_date FROM events)
"""


def events_as_users(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("name"),
        F.substring("event_type", 1, 2).alias("city"),
        F.col("ts").alias("effective_date"),
    )


@register(
    "latest_then_required",
    _EVENTS_USERS_SQL
    + """
SELECT * FROM (
  SELECT * FROM u
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY effective_date DESC NULLS LAST, event_id DESC) = 1)
WHERE id IS NOT NULL AND name IS NOT NULL
""",
)
def latest_then_required(spark, sf_dir):
    latest = latest_per_key(events_as_users(spark, sf_dir), "id", "effective_date", tie_break="event_id")
    return require_fields(latest, ["id", "name"])


# ---------------------------------------------------------------- mapping enrichment (O-10)


@register(
    "map_column_coalesce",
    """
WITH m AS (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation WHERE n_regionkey IN (0, 1, 3)),
     c AS (SELECT c_custkey, c_name, c_acctbal, 'N' || CAST(c_nationkey AS VARCHAR) AS nation FROM customer)
SELECT c.c_custkey, c.c_name, c.c_acctbal, coalesce(m.label, c.nation) AS nation
FROM c LEFT JOIN m ON c.nation = m.code
""",
)
def map_column_coalesce(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    mapping = n.where(F.col("n_regionkey").isin(0, 1, 3)).select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("label")
    )
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("nation")
    )
    return map_column(c, mapping, "nation", "code", "label")


# ---------------------------------------------------------------- gold flow (O-17, O-11)

_GOLD_CFG_SQL = """,
cfg AS (SELECT DISTINCT substr(event_type, 1, 2) AS city_abb, upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' City' AS city
        FROM events WHERE event_type IN ('click', 'purchase'))"""


def _gold_cte(name: str, where: str = "") -> str:
    return f""",
d_{name} AS (SELECT * FROM u {where}
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY effective_date DESC NULLS LAST, event_id DESC) = 1),
{name} AS (SELECT d.event_id, d.id, d.name, d.effective_date, coalesce(cfg.city, d.city) AS city
      FROM d_{name} d LEFT JOIN cfg ON d.city = cfg.city_abb
      WHERE d.id IS NOT NULL AND d.name IS NOT NULL)"""


_GOLD_SQL = _EVENTS_USERS_SQL + _GOLD_CFG_SQL + _gold_cte("g") + "\nSELECT * FROM g"

# First half published, then the whole month merged in: keys gone from the new gold set keep
# their first-half row (MERGE never deletes unmatched target rows).
_GOLD_MERGE_SQL = (
    _EVENTS_USERS_SQL
    + _GOLD_CFG_SQL
    + _gold_cte("g")
    + _gold_cte("g1", "WHERE effective_date < TIMESTAMP '2024-01-15'")
    + "\nSELECT * FROM g UNION ALL SELECT * FROM g1 WHERE id NOT IN (SELECT id FROM g)"
)


def city_mapping(spark, sf_dir) -> DataFrame:
    """City names for two event-type codes, derived from the events table."""
    e = table(spark, sf_dir, "events")
    return (
        e.where(F.col("event_type").isin("click", "purchase"))
        .select(
            F.substring("event_type", 1, 2).alias("city_abb"),
            F.concat(F.initcap("event_type"), F.lit(" City")).alias("city"),
        )
        .distinct()
    )


def gold_frame(spark, sf_dir) -> DataFrame:
    mapping = city_mapping(spark, sf_dir)
    # the mapping comes out of a full events scan: no separate size count, AQE sizes it at runtime
    return build_gold(
        events_as_users(spark, sf_dir), mapping, key="id", order_by="effective_date", tie_break="event_id",
    )


@register("gold_publish", _GOLD_SQL)
def gold_publish(spark, sf_dir):
    path = shared_dir(spark, "gold-users")
    publish(gold_frame(spark, sf_dir), path=path, mode="overwrite")
    return spark.read.parquet(path)


@register("gold_merge_publish", _GOLD_MERGE_SQL)
def gold_merge_publish(spark, sf_dir):
    """Publish the first half of the month, then merge the whole month's gold rows into it."""
    path = shared_dir(spark, "gold-users-merge")
    src = events_as_users(spark, sf_dir)
    first = src.where(F.col("effective_date") < F.lit("2024-01-15").cast("timestamp_ntz"))
    mapping = city_mapping(spark, sf_dir)
    publish(build_gold(first, mapping, tie_break="event_id"), path=path, mode="overwrite")
    publish(gold_frame(spark, sf_dir), path=path, mode="merge", on="id")
    return spark.read.parquet(path)


# ---------------------------------------------------------------- merge (O-12)

_MERGE_TS = """
WITH t AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_totalprice AS v, o_orderdate AS d
           FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     s AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_totalprice * 2 AS v, o_orderdate AS d
           FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""


def _merge_frames(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"), F.col("o_totalprice").alias("v"), F.col("o_orderdate").alias("d")
    )
    s = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"), (F.col("o_totalprice") * 2).alias("v"), F.col("o_orderdate").alias("d")
    )
    return t, s


@register(
    "merge_upsert_delete",
    _MERGE_TS
    + """
SELECT coalesce(t.k, s.k) AS k,
       CASE WHEN t.k IS NULL OR s.v > 500000 THEN s.st ELSE t.st END AS st,
       CASE WHEN t.k IS NULL OR s.v > 500000 THEN s.v ELSE t.v END AS v,
       CASE WHEN t.k IS NULL OR s.v > 500000 THEN s.d ELSE t.d END AS d
FROM t FULL JOIN s ON t.k = s.k
WHERE NOT (t.k IS NOT NULL AND s.k IS NOT NULL AND s.v < 100000)
""",
)
def merge_upsert_delete(spark, sf_dir):
    t, s = _merge_frames(spark, sf_dir)
    return (
        MergeTarget.forFrame(t)
        .alias("t")
        .merge(s.alias("s"), on="k")
        .whenMatchedDelete(condition="s.v < 100000")
        .whenMatchedUpdateAll(condition="s.v > 500000")
        .whenNotMatchedInsertAll()
        .result()
    )


@register(
    "merge_update_set_insert_values",
    _MERGE_TS
    + """
SELECT coalesce(t.k, s.k) AS k,
       CASE WHEN t.k IS NULL THEN 'N' WHEN s.k IS NOT NULL THEN 'M' ELSE t.st END AS st,
       CASE WHEN t.k IS NULL THEN NULL WHEN s.k IS NOT NULL THEN t.v + s.v ELSE t.v END AS v,
       CASE WHEN t.k IS NULL THEN s.d ELSE t.d END AS d
FROM t FULL JOIN s ON t.k = s.k
""",
)
def merge_update_set_insert_values(spark, sf_dir):
    t, s = _merge_frames(spark, sf_dir)
    return (
        MergeTarget.forFrame(t)
        .alias("t")
        .merge(s.alias("s"), "t.k = s.k")
        .whenMatchedUpdate(set={"st": "'M'", "v": "t.v + s.v"})
        .whenNotMatchedInsert(values={"k": "s.k", "st": "'N'", "d": "s.d"})
        .result()
    )


@register(
    "merge_conditional_insert",
    _MERGE_TS
    + """
SELECT t.k, t.st, t.v, t.d FROM t
UNION ALL
SELECT s.k, s.st, s.v, s.d FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k) AND s.st = 'O'
""",
)
def merge_conditional_insert(spark, sf_dir):
    t, s = _merge_frames(spark, sf_dir)
    return (
        MergeTarget.forFrame(t).alias("t").merge(s.alias("s"), on="k").whenNotMatchedInsertAll(condition="s.st = 'O'").result()
    )


_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _order_table(spark, sf_dir, purpose: str, where: str = "true") -> str:
    """The orders as an external catalog table partitioned by status, in the shared folder."""
    place = shared_dir(spark, purpose)
    name = os.path.basename(place).replace("-", "_")
    orders = table(spark, sf_dir, "orders").where(where)
    orders.write.partitionBy("o_orderstatus").option("path", f"{place}/table").saveAsTable(name)
    return name


@register(
    "publish_partitioned_table",
    """
SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus <> 'F'
""",
)
def publish_partitioned_table(spark, sf_dir):
    """A partitioned table published over from itself (O-11): one partition goes, one comes, the others change."""
    name = _order_table(spark, sf_dir, "published-orders")
    rows = spark.table(name).where("o_orderstatus <> 'F'")
    status = F.when(F.col("o_totalprice") > 400000, "X").otherwise(F.col("o_orderstatus"))
    publish(rows.withColumn("o_orderstatus", status).withColumn("o_totalprice", F.col("o_totalprice") + 1), table=name)
    return spark.table(name).select(*_ORDER_COLS.split(", "))


@register(
    "merge_partitioned_table",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 2 = 0
""",
)
def merge_partitioned_table(spark, sf_dir):
    """MERGE into a partitioned catalog table by its name (2.1 scan by name, 2.2 table merge)."""
    name = _order_table(spark, sf_dir, "merged-orders", "o_orderkey % 2 = 0")
    source = table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    MergeTarget.forName(spark, name).alias("t").merge(source.alias("s"), "t.o_orderkey = s.o_orderkey").whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
    return spark.table(name).select(*_ORDER_COLS.split(", "))


@register(
    "merge_bucketed_table",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 500 = 1 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders WHERE (o_orderkey % 500 = 1 OR o_orderkey % 2 = 0) AND NOT (o_orderkey % 500 = 2 AND o_totalprice > 200000)
""",
)
def merge_bucketed_table(spark, sf_dir):
    """MERGE of few keys into a table in buckets of its key: only their buckets are rewritten (O-12)."""
    place = shared_dir(spark, "bucketed-orders")
    name = os.path.basename(place).replace("-", "_")
    orders = table(spark, sf_dir, "orders")
    write_bucketed(orders.where("o_orderkey % 2 = 0"), "o_orderkey", 16, table=name, location=f"{place}/table")
    source = orders.where("o_orderkey % 500 IN (1, 2)").withColumn("o_totalprice", F.when(F.expr("o_orderkey % 500 = 1"), F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
    merge = MergeTarget.forName(spark, name).alias("t").merge(source.alias("s"), on="o_orderkey")
    merge.whenMatchedDelete(condition="s.o_orderkey % 500 = 2 AND s.o_totalprice > 200000").whenMatchedUpdateAll().whenNotMatchedInsertAll(condition="s.o_orderkey % 500 = 1").execute()
    return spark.table(name).select(*_ORDER_COLS.split(", "))


# ---------------------------------------------------------------- frame equality (O-14)

_LI_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@register(
    "frame_diff",
    f"""
WITH a AS (SELECT {_LI_COLS} FROM lineitem),
     b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                  CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
                  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
           FROM lineitem WHERE l_discount <> 0.05
           UNION ALL SELECT {_LI_COLS} FROM lineitem WHERE l_tax = 0.08),
     lo AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
     ro AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
SELECT *, 'left_only' AS _side, count(*) AS _count FROM lo GROUP BY ALL
UNION ALL
SELECT *, 'right_only' AS _side, count(*) AS _count FROM ro GROUP BY ALL
""",
)
def frame_diff_query(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cols = [c.strip() for c in _LI_COLS.split(",")]
    a = li.select(*cols)
    changed = li.where(F.col("l_discount") != 0.05).withColumn(
        "l_quantity", F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    b = changed.select(*cols).unionByName(li.where(F.col("l_tax") == 0.08).select(*cols))
    return frame_diff(a, b)


@register(
    "frame_diff_by_digest",
    f"""
WITH a AS (SELECT {_LI_COLS} FROM lineitem),
     b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                  CASE WHEN l_orderkey % 2000 = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
                  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
           FROM lineitem WHERE l_orderkey % 3000 <> 2
           UNION ALL SELECT {_LI_COLS} FROM lineitem WHERE l_orderkey % 3000 = 3),
     lo AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
     ro AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
SELECT *, 'left_only' AS _side, count(*) AS _count FROM lo GROUP BY ALL
UNION ALL
SELECT *, 'right_only' AS _side, count(*) AS _count FROM ro GROUP BY ALL
""",
)
def frame_diff_by_digest_query(spark, sf_dir):
    """Two versions of lineitem that differ in few rows: changed, missing and doubled ones (O-14)."""
    li = table(spark, sf_dir, "lineitem").select(*[c.strip() for c in _LI_COLS.split(",")])
    quantity = F.when(F.col("l_orderkey") % 2000 == 1, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    b = li.where("l_orderkey % 3000 <> 2").withColumn("l_quantity", quantity).unionByName(li.where("l_orderkey % 3000 = 3"))
    return frame_diff_by_digest(li, b)


# ---------------------------------------------------------------- landing contracts (O-4 .. O-7, O-16)

_DROP_ROWS_SQL = """
WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(18 + c_custkey % 53 AS INTEGER) AS age,
                  n_name AS country, 2025 AS year, 10 AS month, CAST(c_custkey % 9 + 1 AS INTEGER) AS day
           FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
"""


def _landing(spark, sf_dir, fmt):
    area = LandingArea(shared_dir(spark, "landing"), "customer", fmt)
    write_customer_drops(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), area)
    return area


def _rows_in(listed: DataFrame, area: LandingArea) -> DataFrame:
    """``listed`` (a frame with ``path``) with the number of rows of each file: a file missed, listed twice
    or wrongly named changes the sums."""
    spark = listed.sparkSession
    if area.fmt == "json":
        counts = area.lines(spark).groupBy("path").agg(F.count("*").alias("n_rows"))
    else:
        rows = spark.read.option("recursiveFileLookup", "true").schema("id string").format(area.fmt).load(area.object_dir)
        counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_rows"))
    same = F.regexp_replace("path", "^file:/+", "/")
    return listed.withColumn("path", same).join(counts.withColumn("path", same), "path")


def _breach_days(spark, sf_dir, fmt):
    area = _landing(spark, sf_dir, fmt)
    found = contract_breaches(spark, area, CUSTOMER_CONTRACT, (2025, 10, 1))
    p = F.col("path")
    return _rows_in(found, area).groupBy(path_year(p).alias("year"), path_month(p).alias("month"), path_day(p).alias("day"), "reason").agg(F.sum("n_rows").alias("n_rows"))


@register(
    "landing_detect_files",
    _DROP_ROWS_SQL + "SELECT year, month, day, count(*) AS n_rows FROM r WHERE day >= 4 GROUP BY ALL",
)
def landing_detect_files(spark, sf_dir):
    area = _landing(spark, sf_dir, "parquet")
    found = area.files(spark, (2025, 10, 4)).select("year", "month", "day", "path")
    return _rows_in(found, area).groupBy("year", "month", "day").agg(F.sum("n_rows").alias("n_rows"))


@register(
    "landing_contract_breaches",
    _DROP_ROWS_SQL + "SELECT year, month, day, 'unexpected column city string' AS reason, count(*) AS n_rows FROM r WHERE day = 6 GROUP BY ALL",
)
def landing_contract_breaches(spark, sf_dir):
    return _breach_days(spark, sf_dir, "parquet")


@register(
    "landing_json_breaches",
    _DROP_ROWS_SQL + "SELECT year, month, day, 'unexpected columns: city' AS reason, count(*) AS n_rows FROM r WHERE day = 6 GROUP BY ALL",
)
def landing_json_breaches(spark, sf_dir):
    return _breach_days(spark, sf_dir, "json")


@register(
    "landing_null_breaches",
    "SELECT CAST(c_custkey % 9 + 1 AS INTEGER) AS day, count(*) FILTER (WHERE c_custkey % 50 = 7) AS n_null, count(*) AS n_rows "
    "FROM customer GROUP BY ALL HAVING count(*) FILTER (WHERE c_custkey % 50 = 7) > 0",
)
def landing_null_breaches(spark, sf_dir):
    """NULLs in a NOT NULL column, counted by file statistics (O-5)."""
    area = LandingArea(shared_dir(spark, "landing-nulls"), "customer", "parquet")
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        F.when(key % 50 != 7, key.cast("string")).alias("id"), F.lit(2025).alias("year"), F.lit(10).alias("month"), (key % 9 + 1).cast("int").alias("day")
    )
    rows.write.partitionBy("year", "month", "day").parquet(area.object_dir)
    contract = StructType.fromDDL("id string not null")
    found = _rows_in(contract_breaches(spark, area, contract, check_nulls=True), area)
    n_null = F.regexp_extract("reason", "^column id: (\\d+) NULL values$", 1).cast("long")
    per_day = found.groupBy(path_day(F.col("path")).alias("day")).agg(F.sum(n_null).alias("n_null"))
    totals = _rows_in(area.files(spark).select("day", "path"), area).groupBy("day").agg(F.sum("n_rows").alias("n_rows"))
    return per_day.join(totals, "day")


EVENT_CONTRACT = "event_id bigint, payload struct<kind: string, value: double>, tags array<struct<k: string, v: bigint>>"


@register(
    "landing_nested_breaches",
    """
SELECT CAST(day(ts) AS INTEGER) AS day,
       'type of payload.value: expected double, got string; missing column tags[].v bigint; unexpected column tags[].w int' AS reason,
       count(*) AS n_rows
FROM events WHERE day(ts) % 3 = 2 GROUP BY ALL
""",
)
def landing_nested_breaches(spark, sf_dir):
    """Nested drops against a nested contract (O-5, O-15): a third conforms, a third is narrower, a third breaks it."""
    area = LandingArea(shared_dir(spark, "landing-nested"), "event", "parquet")
    e = table(spark, sf_dir, "events")
    when = [F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day")]

    def drop(rest: int, value: str, tag: str) -> None:
        payload = F.struct(F.col("event_type").alias("kind"), F.col("value").cast(value).alias("value"))
        tags = F.array(F.expr(f"named_struct('k', event_type, {tag})"))
        rows = e.where(F.dayofmonth("ts") % 3 == rest).select("event_id", payload.alias("payload"), tags.alias("tags"), *when)
        rows.write.mode("append").partitionBy("year", "month", "day").parquet(area.object_dir)

    drop(0, "double", "'v', user_id")
    drop(1, "float", "'v', CAST(user_id % 100 AS INT)")
    drop(2, "string", "'w', 1")
    found = contract_breaches(spark, area, StructType.fromDDL(EVENT_CONTRACT), widen=True)
    return _rows_in(found, area).groupBy(path_day(F.col("path")).alias("day"), "reason").agg(F.sum("n_rows").alias("n_rows"))


@register(
    "landing_bronze_rows",
    _DROP_ROWS_SQL + "SELECT * FROM r WHERE day >= 3 AND day <> 6",
)
def landing_bronze_rows(spark, sf_dir):
    area = _landing(spark, sf_dir, "parquet")
    apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{area.root}/_movement_log", (2025, 10, 3))
    return load_conforming(spark, area, CUSTOMER_CONTRACT, (2025, 10, 3))


def _bronze(spark, sf_dir, fmt):
    area = _landing(spark, sf_dir, fmt)
    apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{area.root}/_movement_log", (2025, 10, 3))
    return load_conforming(spark, area, CUSTOMER_CONTRACT, (2025, 10, 3))


@register("landing_csv_bronze_rows", _DROP_ROWS_SQL + "SELECT * FROM r WHERE day >= 3 AND day <> 6")
def landing_csv_bronze_rows(spark, sf_dir):
    return _bronze(spark, sf_dir, "csv")


@register("landing_json_bronze_rows", _DROP_ROWS_SQL + "SELECT * FROM r WHERE day >= 3 AND day <> 6")
def landing_json_bronze_rows(spark, sf_dir):
    return _bronze(spark, sf_dir, "json")


@register(
    "landing_quarantine_log",
    _DROP_ROWS_SQL + """
SELECT day, true AS moved_to_quarantine, 'unexpected columns: city' AS corrupted_message, 'OK' AS move_status,
       true AS dated, count(*) AS n_rows FROM r WHERE day = 6 GROUP BY ALL""",
)
def landing_quarantine_log(spark, sf_dir):
    """Movement log of one contract run; the run's own paths are reduced to day and folder."""
    area = _landing(spark, sf_dir, "json")
    log = apply_data_contract(spark, area, CUSTOMER_CONTRACT, f"{area.root}/_movement_log", (2025, 10, 1))
    moved = F.col("new_file_path") == F.replace(F.col("old_file_path"), F.lit("/object=customer/"), F.lit("/object=customer_corrupted/"))
    there = _rows_in(log.withColumn("path", F.col("new_file_path")), LandingArea(area.root, "customer_corrupted", "json"))
    return there.groupBy(
        path_day(F.col("old_file_path")).alias("day"), moved.alias("moved_to_quarantine"), "corrupted_message", "move_status",
        F.col("inserted_at").isNotNull().alias("dated"),
    ).agg(F.sum("n_rows").alias("n_rows"))


#: Declared contracts, each with one difference from the table as it is.
TABLE_CONTRACTS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(12,2), o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string, c_phone string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


@register(
    "schema_breaches",
    """
SELECT * FROM (VALUES ('orders', 'type of o_totalprice: expected decimal(12,2), got double'),
                      ('customer', 'missing column c_phone string'),
                      ('supplier', 'unexpected column s_acctbal double')) AS v(table_name, reason)
""",
)
def schema_breaches_query(spark, sf_dir):
    """The given tables' files against declared contracts, from their footers (O-15)."""
    found = []
    for name, ddl in TABLE_CONTRACTS.items():
        files = spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/{name}.parquet").select("path")
        reasons = file_schema_breaches(files, "parquet", StructType.fromDDL(ddl))
        found.append(reasons.select(F.lit(name).alias("table_name"), "reason").distinct())
    return reduce(DataFrame.unionByName, found)


@register(
    "merge_on_with_condition",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders",
)
def merge_on_with_condition(spark, sf_dir):
    """Two source rows a key, of which the condition leaves one: a match, not a conflict."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    third = orders.where("o_orderkey % 3 = 0")
    source = third.select("o_orderkey", (F.col("o_totalprice") + 1).alias("price"), F.lit("U").alias("op")).unionByName(
        third.select("o_orderkey", (F.col("o_totalprice") + 2).alias("price"), F.lit("X").alias("op"))
    )
    merge = MergeTarget.forFrame(orders).alias("t").merge(source.alias("s"), "s.op = 'U'", on="o_orderkey")
    return merge.whenMatchedUpdate(set={"o_totalprice": "s.price"}).result()


# ---------------------------------------------------------------- streaming (O-13)

EVENT_CHECKS = [
    DataCheckClause("value > 90", "value above 90"),
    DataCheckClause("event_type = 'error'", "error event"),
    DataCheckClause("props NOT LIKE '{%'", "props not a JSON object"),
]


def _event_stream_source(spark, sf_dir):
    """The events table written as several files so the stream sees several micro-batches."""
    src = shared_dir(spark, "events-stream-src")
    table(spark, sf_dir, "events").repartitionByRange(5, "ts").write.mode("overwrite").parquet(src)
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


@register(
    "stream_checks",
    """
SELECT event_id, user_id, event_type, value,
       concat_ws('|', CASE WHEN value > 90 THEN 'value above 90' END,
                      CASE WHEN event_type = 'error' THEN 'error event' END,
                      CASE WHEN props NOT LIKE '{%' THEN 'props not a JSON object' END) AS fail_messages
FROM events WHERE value > 90 OR event_type = 'error' OR props NOT LIKE '{%'
""",
)
def stream_checks_query(spark, sf_dir):
    stream = _event_stream_source(spark, sf_dir)
    out = shared_dir(spark, "stream-checks-out")
    q = stream_checks(stream, EVENT_CHECKS, out, shared_dir(spark, "stream-checks-ckpt"))
    q.awaitTermination()
    bad = read_checked(spark, out, "bad")
    return flat(bad.select("event_id", "user_id", "event_type", "value", "fail_messages"))


@register(
    "stream_latest",
    """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""",
)
def stream_latest_query(spark, sf_dir):
    """State in RocksDB, one state partition per core; the target in buckets of the key."""
    stream = _event_stream_source(stream_session(spark, spark.sparkContext.defaultParallelism, rocksdb=True), sf_dir)
    target = shared_dir(spark, "stream-latest-target")
    q = upsert_latest(stream, "user_id", "ts", target, shared_dir(spark, "stream-latest-ckpt"), tie_break="event_id", buckets=8)
    q.awaitTermination()
    return read_bucketed(spark, target)


@register(
    "stream_latest_in_target",
    """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""",
)
def stream_latest_in_target(spark, sf_dir):
    """Without a state store: the target's rows are what a micro-batch is compared with."""
    target = shared_dir(spark, "stream-latest-stateless")
    q = upsert_latest(
        _event_stream_source(spark, sf_dir), ["user_id", "event_type"], "ts", target, shared_dir(spark, "stream-latest-ckpt"), tie_break="event_id",
        buckets=8, state="target",
    )
    q.awaitTermination()
    return read_bucketed(spark, target)


@register("stream_gold", _GOLD_SQL)
def stream_gold_query(spark, sf_dir):
    """The gold flow over the events stream (5 micro-batches), merged into a parquet target."""
    stream = _event_stream_source(spark, sf_dir).select(
        "event_id",
        F.col("user_id").alias("id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("name"),
        F.substring("event_type", 1, 2).alias("city"),
        F.col("ts").alias("effective_date"),
    )
    target = shared_dir(spark, "stream-gold-target")
    # the mapping comes from a full events scan: compute it once, not in every micro-batch
    mapping = cut_lineage(city_mapping(spark, sf_dir))
    q = upsert_gold_stream(
        stream, mapping, target, shared_dir(spark, "stream-gold-ckpt"), tie_break="event_id",
        state_partitions=spark.sparkContext.defaultParallelism,  # one state partition per core
        buckets=8,
    )
    q.awaitTermination()
    return read_bucketed(spark, target)
