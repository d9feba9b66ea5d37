"""Transaction tables derived from the generated star schema; see FIXTURES.md for what each twist exercises."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.columns import nan_to_null

# One text for both engines: Spark runs it for the queries, DuckDB as the first CTE of their SQL.
TRANSACTIONS_SQL = """
select 'T' || cast(e.event_id as string) as TransactionId,
       'B' || cast(cast(floor(e.event_id / 4) as bigint) as string) as BatchId,
       'A' || cast(e.user_id * 3 + e.k % 4 as string) as AccountId,
       'S' || cast(cast(floor((e.user_id * 3 + e.k % 4) / 2) as bigint) as string) as SubscriptionId,
       'C' || cast(e.user_id as string) as CustomerId,
       r.r_name as CurrencyCode,
       case when e.user_id % 29 = 0 then null else n.n_nationkey end as CountryCode,
       'P' || cast(e.k % 6 as string) as ProviderId,
       'PR' || cast(e.k % 23 as string) as ProductId,
       e.event_type as ProductCategory,
       8 + e.k % 5 as ChannelId,
       case when e.event_id % 97 = 0 then null
            when e.event_type = 'error' then -e.value
            else e.value end as Amount,
       e.value as Value,
       e.ts as TransactionStartTime,
       e.k % 5 as PricingStrategy,
       case when e.event_id % 500 = 0 then 1 else 0 end as FraudResult
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {events}) e
left join {customer} c on e.user_id = c.c_custkey
left join {nation} n on c.c_nationkey = n.n_nationkey
left join {region} r on n.n_regionkey = r.r_regionkey
"""

ORDER_TRANSACTIONS_SQL = """
select 'O' || cast(o.o_orderkey as string) as TransactionId,
       'C' || cast(o.o_custkey as string) as CustomerId,
       'A' || cast(o.o_custkey as string) || '-' || o.o_orderstatus as AccountId,
       r.r_name as CurrencyCode,
       n.n_nationkey as CountryCode,
       cast(substr(o.o_orderpriority, 1, 1) as int) as ChannelId,
       o.o_totalprice as Amount,
       o.o_totalprice as Value,
       o.o_orderdate as TransactionStartTime
from {orders} o
left join {customer} c on o.o_custkey = c.c_custkey
left join {nation} n on c.c_nationkey = n.n_nationkey
left join {region} r on n.n_regionkey = r.r_regionkey
"""


# The columns read from each table. Declared, so that opening a table needs no job.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    # Hours and weekdays are read in the session time zone; the fixtures are in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    frames = {t: spark.read.schema(_SCHEMAS[t]).parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    tx = spark.sql(sql, **frames)
    return nan_to_null(tx.withColumn("TransactionStartTime", F.col("TransactionStartTime").cast("timestamp")))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16-column transactions from the events table."""
    return _view(spark, sf_dir, TRANSACTIONS_SQL, "events", "customer", "nation", "region")


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """9-column transactions from the orders table, with customers of a single transaction."""
    return _view(spark, sf_dir, ORDER_TRANSACTIONS_SQL, "orders", "customer", "nation", "region")
