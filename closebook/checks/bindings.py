"""The test tables seen as finance tables. Only checks, tests and the benchmark use these views.

Amounts become decimals before any arithmetic, so that both engines compute the same cents.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.operators.calendar import date_dimension

STATEMENTS = """
select o_orderkey as statement_id, o_custkey as organization_id, o_orderstatus as status
from {orders}
"""

STATEMENT_LINES = """
select l_orderkey as statement_id,
       trunc(cast(l_shipdate as date), 'MM') as reportmonth,
       cast(l_shipdate as date) as payment_date,
       l_partkey as sku,
       cast(cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as decimal(15,2))
            * cast(1 - cast(l_discount as decimal(4,2)) as decimal(3,2)) as decimal(33,2)) as amount
from {lineitem}
"""

ORGANIZATIONS = """
select c_custkey as organization_id,
       case when c_mktsegment = 'AUTOMOBILE' then 'AmEx' else c_mktsegment end as partner_type
from {customer}
"""

PRODUCTS = """
select p_partkey as sku,
       p_name as sku_product_description,
       concat('4', lpad(cast(p_size as string), 4, '0')) as netsuite_gl_account_number,
       case when p_type in ('PROMO', 'ECONOMY') then 'Subscription Revenue'
            when p_type in ('SMALL', 'MEDIUM') then 'Transaction Revenue'
            else 'Other Revenue' end as product_group,
       case when p_partkey % 4 = 0 then p_brand || ' - ' || p_name
            when p_partkey % 4 = 1 then cast(p_size as string) || '-' || p_name
            when p_partkey % 4 = 2 then p_name end as netsuite_sku
from {part}
"""

NORTHCARD = """
select cast(user_id % 5 as string) as program,
       cast(event_id % 97 as string) as batch_number,
       cast(event_id as string) as transaction_token,
       cast(cast(ts as date) as string) as post_date,
       event_type as transaction_status,
       cast(user_id as string) as acting_user,
       cast(value as string) as amount
from {events}
"""

FLEETPAY = """
select cast(extract(year from ts) as string) as `Year`,
       cast(extract(month from ts) as string) as `Month`,
       cast(extract(day from ts) as string) as `Day`,
       concat('A', cast(user_id as string)) as `Account`,
       cast(user_id as string) as `CustID`,
       lpad(cast(event_id % 10000 as string), 4, '0') as `Card Last 4`,
       cast(event_id as string) as `Token`,
       event_type as `Merchant Name`,
       cast(5000 + event_id % 900 as string) as `MCC`,
       case when event_id % 50 = 0 then 'n/a' else cast(value as string) end as `Spend`
from {events}
"""

SOURCE_RUNS = """
select concat('src-', cast(user_id as string)) as job_name,
       event_id as run_id,
       case event_type when 'error' then 'FAILED' when 'signup' then 'RUNNING' else 'SUCCEEDED' end as state,
       ts as started_on,
       case when event_type <> 'signup' then ts end as completed_on
from {events}
"""

CASH_FLOWS = """
select concat(p_type, '/', cast(l_suppkey % 10 as string)) as option_id,
       (cast(extract(year from l_shipdate) as int) - 1995) % (4 + cast(l_suppkey % 10 as int)) as t,
       -cast(l_extendedprice as decimal(22,2)) as amount
from {lineitem}
join {part} on l_partkey = p_partkey
"""

# Flows over many periods, as many as the parameter says.
LONG_FLOWS = """
select concat(p_type, '/', cast(l_suppkey % 10 as string)) as option_id,
       cast(l_orderkey % :periods as int) as t,
       -cast(l_extendedprice as decimal(15,2)) as amount
from {lineitem}
join {part} on l_partkey = p_partkey
"""

LINES = """
select l_orderkey as order_key, l_linenumber as line_number, l_partkey as sku, cast(l_shipdate as date) as payment_date,
       cast(l_extendedprice as decimal(15,2)) as amount, l_returnflag as return_flag,
       year(l_shipdate) as year, date_format(l_shipdate, 'yyyy-MM') as partition_id
from {lineitem}
"""

# Some lines have no product.
SOLD = """
select case when l_linenumber = 7 then null else l_partkey end as sku, l_quantity as quantity from {lineitem}
"""

EXCLUDED = """
select p_partkey as sku from {part} where p_size % 5 = 0
"""

DAILY = """
select date_format(l_shipdate, 'yyyy-MM-dd') as partition_id, l_partkey % 100 as sku_group, count(*) as n_lines,
       cast(sum(cast(l_extendedprice as decimal(15,2))) as decimal(38,2)) as amount
from {lineitem} where year(l_shipdate) = 1997 group by 1, 2
"""

ASSETS = """
select p_partkey as asset_id, cast(p_retailprice as decimal(22,2)) as price, p_size as life
from {part}
"""

ASSUMPTIONS = """
select concat('part-', cast(p_partkey as string)) as assumption,
       case p_partkey % 4
            when 0 then concat('$', format_number(cast(p_retailprice as decimal(15,2)) * 37, 2))
            when 1 then concat(cast(p_size as string), ' years')
            when 2 then concat(cast(cast(p_size as decimal(6,1)) / 4 as decimal(6,2)), '%')
            else p_name end as value
from {part}
"""

# Declared, so that no query starts with a job that infers them.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Fixed-date holidays of the years the ship dates fall in.
HOLIDAYS = [date(year, month, day) for year in range(1995, 2002) for month, day in ((1, 1), (7, 4), (11, 11), (12, 25))]

RUN_HOLIDAYS = [date(2024, 1, 1), date(2024, 1, 15)]

ALL_MONTHS = (date(1900, 1, 1), date(9999, 1, 1))


class Bindings:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self._dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self._dir}/{name}.parquet")

    def view(self, sql: str, **parameters) -> DataFrame:
        names = [n for n in SCHEMAS if f"{{{n}}}" in sql]
        return self.spark.sql(sql, args=parameters, **{n: self.table(n) for n in names})

    def revenue_lines(self) -> DataFrame:
        """Lines with their organisation and partner. The headers are joined first: lines are shuffled once."""
        headers = self.view(STATEMENTS).join(self.view(ORGANIZATIONS), "organization_id")
        return self.view(STATEMENT_LINES).join(headers, "statement_id").select(
            "reportmonth", "organization_id", "payment_date", "sku", "partner_type", "amount"
        )

    def products(self) -> DataFrame:
        return self.view(PRODUCTS)

    def register_report_sources(self) -> None:
        self.view(STATEMENTS).createOrReplaceTempView("statements")
        self.view(STATEMENT_LINES).createOrReplaceTempView("statement_lines")
        self.view(ORGANIZATIONS).createOrReplaceTempView("organizations")
        self.view(PRODUCTS).createOrReplaceTempView("product_sku_dim")

    def run_days(self) -> DataFrame:
        """The dates of all months that sources ran in."""
        return date_dimension(self.table("events"), F.col("ts"), RUN_HOLIDAYS)

    def date_dim(self) -> DataFrame:
        """The dates of all months that lines were shipped in."""
        return date_dimension(self.table("lineitem"), F.col("l_shipdate"), HOLIDAYS)
