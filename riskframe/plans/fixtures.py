"""Deterministic views that give the test tables the columns of the risk domain.

One SQL text serves Spark and the checking engine; only array indexing differs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_MONTH = (
    "(substr('JanFebMarAprMayJunJulAugSepOctNovDec', (month({d})-1)*3+1, 3)"
    " || '-' || cast(year({d}) as string))"
)

VIEWS = {
    "retail_lines": """
select concat(cast(l_orderkey as string),'-',cast(l_partkey as string),'-',
              cast(l_suppkey as string),'-',cast(l_linenumber as string)) as line_key,
       case when o_custkey % 50 = 0 then null else o_custkey end as customer_id,
       case when o_orderkey % 11 = 0 then concat('C', cast(o_orderkey as string))
            else cast(o_orderkey as string) end as invoice,
       o_orderdate + interval '1' hour * cast(o_orderkey % 24 as int) as invoice_ts,
       case when l_returnflag = 'R' and l_linenumber = 1 then -l_quantity
            else l_quantity end as quantity,
       case when l_discount > 0.095 and l_tax < 0.005 then cast(0 as double)
            else l_extendedprice end as price
from lineitem join orders on l_orderkey = o_orderkey""",
    "applicants": """
select c_custkey as applicant_id,
       case when c_custkey % 15 = 0 then 1 else 0 end as serious_dlqin2yrs,
       cast((c_custkey * 37) % 1300 as double) / 1000 as utilization,
       cast((c_custkey * 53) % 112 as int) as age,
       cast(case when c_custkey % 97 = 0 then 98 when c_custkey % 89 = 0 then 96
                 else c_custkey % 3 end as int) as late_30_59,
       cast((c_custkey * 91) % 1500 as double) / 100 as debt_ratio,
       case when c_acctbal < 0 or c_custkey % 5 = 0 then null
            else c_acctbal * 8 end as monthly_income,
       cast(c_custkey % 20 as int) as open_lines,
       cast(case when c_custkey % 97 = 0 then 98 else (c_custkey * 7) % 4 end as int) as late_90,
       cast(c_custkey % 4 as int) as real_estate,
       cast(case when c_custkey % 97 = 0 then 98
                 else (c_custkey * 3) % 2 end as int) as late_60_89,
       cast(case when c_custkey % 31 = 0 then null else c_custkey % 6 end as int) as dependents
from customer""",
    "loans": f"""
select o_orderkey as loan_id,
       case o_orderkey % 9 when 0 then 'Charged Off' when 1 then 'Default'
            when 2 then 'Late (31-120 days)' when 3 then 'Late (16-30 days)'
            when 4 then null when 5 then 'Fully Paid' else 'Current' end as loan_status,
       {_MONTH.format(d="o_orderdate")} as issue_d,
       case when o_orderkey % 211 = 0 then 'bad'
            else {_MONTH.format(d="last_ship")} end as last_pymnt_d,
       case when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end as term,
       o_totalprice as loan_amnt,
       concat(cast(5 + o_orderkey % 20 as string), '.25%') as int_rate,
       case when o_orderkey % 101 = 0 then 'Z'
            else substr('ABCDE', cast(substr(o_orderpriority,1,1) as int), 1) end as grade,
       case o_orderkey % 13 when 0 then null when 1 then '10+ years' when 2 then '< 1 year'
            when 3 then 'n/a'
            else concat(cast(o_orderkey % 13 - 3 as string), ' years') end as emp_length,
       cast((o_custkey * 1009 + o_orderkey) % 200000 as double) as annual_inc,
       case when o_orderkey % 17 = 0 then null
            else cast((o_orderkey * 13) % 1100 as double) / 10 end as dti,
       cast(600 + (o_orderkey * 7) % 60 * 5 as double) as fico_range_low,
       case when o_orderkey % 19 = 0 then null else cast(o_orderkey % 30 as double) end as open_acc,
       case o_orderkey % 23 when 0 then null when 1 then '' when 2 then 'nan'
            else concat(cast((o_orderkey * 3) % 100 as string), '.5%') end as revol_util,
       case when o_orderkey % 29 = 0 then null else cast(o_orderkey % 60 as double) end as total_acc,
       case when o_orderkey % 37 = 0 then null
            else cast(o_orderkey % 5 as double) end as inq_last_6mths,
       case when o_orderkey % 41 = 0 then null else cast(o_orderkey % 2 as double) end as pub_rec
from orders left join
     (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by l_orderkey) s
     on o_orderkey = l_orderkey""",
    "transactions": """
select vec_id as txn_id,
       cast(vec_id * 60 as double) as time_s,
       """
    + ",\n       ".join(
        f"cast(element_at(embedding, {i}) as double) as v{i}" for i in range(1, 29)
    )
    + """,
       case when vec_id % 83 = 0 then cast('NaN' as double)
            else cast((vec_id * 7919) % 50000 as double) / 100 end as amount,
       case when label = 0 then 1 else 0 end as class
from embeddings""",
    "scored": """
select event_id as id, ts, user_id,
       case when event_type = 'error' then 1 else 0 end as y,
       least(value / cast(500 as double), cast(1 as double)) as p,
       case when event_type = 'error' then cast((event_id * 31) % 100 as double) / 100
            else cast((event_id * 31) % 80 as double) / 100 end as p2,
       cast(18 + user_id % 80 as int) as age
from events""",
    "runs": """
select cast(user_id as string) as run_id, ts, event_type as pipeline,
       case when event_id % 3 = 0 then 'val_loss' else 'pr_auc' end as metric,
       event_id as step, value
from events""",
}

SOURCES = {
    "retail_lines": ["lineitem", "orders"],
    "applicants": ["customer"],
    "loans": ["orders", "lineitem"],
    "transactions": ["embeddings"],
    "scored": ["events"],
    "runs": ["events"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view_on(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    """The view over given tables, batch or streaming."""
    text = VIEWS[name]
    for t in SOURCES[name]:
        text = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **tables)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return view_on(spark, name, **{t: table(spark, sf_dir, t) for t in SOURCES[name]})


def view_sql(name: str) -> str:
    """The view for the checking engine."""
    return VIEWS[name].replace("element_at(", "list_extract(").replace(" string)", " varchar)")
