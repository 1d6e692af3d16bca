"""Delegated SQL: what the user types goes to the query engine as it is."""

from __future__ import annotations

import re

from rowferry.engine import Engine

# Sums of prices are taken as decimals, so that the order of addition cannot show.
TEXTS = {
    "sql_filter": """
        select o_orderkey, o_totalprice, o_orderdate from orders
        where o_orderdate >= timestamp '1996-01-01 00:00:00' and o_totalprice > 100000
          and o_orderpriority like '1%'""",
    "sql_join": """
        select c_name, o_orderkey, l_linenumber, l_extendedprice, s_name
        from customer join orders on c_custkey = o_custkey
        join lineitem on l_orderkey = o_orderkey join supplier on s_suppkey = l_suppkey
        where c_mktsegment = 'BUILDING' and l_returnflag = 'R'""",
    "sql_outer_join": """
        select c_custkey, coalesce(n, 0) as orders
        from customer left join (
          select o_custkey, count(*) as n from orders group by o_custkey) counted
        on o_custkey = c_custkey""",
    "sql_semi_anti": """
        select c_custkey, exists (select 1 from orders where o_custkey = c_custkey) as active,
               not exists (select 1 from orders
                           where o_custkey = c_custkey and o_totalprice > 400000) as small
        from customer""",
    "sql_groupby": """
        select l_returnflag, l_linestatus, count(*) as n,
               cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity,
               cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price,
               min(l_shipdate) as first_ship, max(l_shipdate) as last_ship
        from lineitem group by l_returnflag, l_linestatus""",
    "sql_distinct": """
        select o_orderpriority, count(distinct o_custkey) as customers,
               count(distinct o_orderstatus) as states
        from orders group by o_orderpriority having count(*) > 10""",
    "sql_rollup": """
        select r_name, n_name, count(*) as n,
               cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance
        from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey group by rollup (r_name, n_name)""",
    "sql_cube": """
        select event_type, lang, count(*) as n from events
        join (select doc_id, lang from documents) d on d.doc_id = event_id
        group by cube (event_type, lang)""",
    "sql_window": """
        select o_custkey, month, n, lag(n) over (partition by o_custkey order by month) as prior,
               sum(n) over (partition by o_custkey order by month
                            rows between unbounded preceding and current row)::bigint as running
        from (select o_custkey, count(*) as n,
                     extract(year from o_orderdate) * 12 + extract(month from o_orderdate) as month
              from orders
              group by o_custkey,
                       extract(year from o_orderdate) * 12 + extract(month from o_orderdate)) m""",
    "sql_topk": """
        select o_orderkey, o_totalprice from orders
        order by o_totalprice desc, o_orderkey limit 100""",
    "sql_topk_group": """
        select c_mktsegment, c_custkey, c_acctbal from (
          select c_mktsegment, c_custkey, c_acctbal, row_number() over (
            partition by c_mktsegment order by c_acctbal desc, c_custkey) as nth from customer) t
        where nth <= 10""",
    "sql_setops": """
        (select c_nationkey as nation from customer intersect select s_nationkey from supplier)
        union all
        (select n_nationkey from nation except select s_nationkey from supplier)""",
    "sql_strings_dates": """
        select o_orderkey, upper(o_orderstatus) as status, substring(o_orderpriority, 3, 20) as word,
               extract(year from o_orderdate) as year, extract(month from o_orderdate) as month,
               round(o_totalprice / 1000) as thousands,
               case when o_totalprice > 250000 then 'large' else 'small' end as size
        from orders""",
    "sql_cte_subquery": """
        with spent as (
          select o_custkey, sum(cast(o_totalprice as decimal(18,2))) as total
          from orders group by o_custkey)
        select o_custkey, cast(total as double) as total from spent
        where total > (select avg(total) from spent)""",
}

TABLES = ("customer", "orders", "lineitem", "supplier", "nation", "region", "events", "documents")


def _query(text: str):
    used = [name for name in TABLES if re.search(rf"\b{name}\b", text)]

    def run(spark, sf):
        engine = Engine(spark)
        engine.register_tables(sf, used)
        return engine.query(text)

    return run


QUERIES = {name: _query(text) for name, text in TEXTS.items()}
ORACLES = dict(TEXTS)
