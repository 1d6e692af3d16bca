"""Catalogs and hierarchies over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.operators.catalog import mysql_catalog, postgres_catalog
from rowferry.operators.hierarchy import Level, build_tree, list_tree, path_text, search_tree
from rowferry.plans.tables import load


def nations(spark, sf):
    region, nation = load(spark, sf, "region"), load(spark, sf, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))


def place_tree(spark, sf):
    """Nations come from their own tables, so the large one is read once, without lonely rows to find."""
    upper = nations(spark, sf)
    customer = load(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return build_tree(upper.join(customer, "n_nationkey"), place_levels(), upper)


def place_levels():
    note = F.concat(F.lit("("), F.col("c_mktsegment"), F.lit(")"))
    return [Level("r_name"), Level("n_name"), Level("c_name", note)]


def _flat(nodes):
    return nodes.select(path_text("path").alias("node"), "depth", "name", "description")


def place_search(spark, sf, query, regex=False):
    """Nations, also those without a customer, from their own tables; customers read once."""
    upper = nations(spark, sf)
    customer = load(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return search_tree(upper.join(customer, "n_nationkey"), place_levels(), query, regex, upper)


def cat_tree(spark, sf):
    return _flat(place_tree(spark, sf))


def cat_search_sub(spark, sf):
    return _flat(place_search(spark, sf, "ER#00000007"))


def cat_search_upper(spark, sf):
    """A match on an upper level keeps its ancestors, not its descendants."""
    return _flat(place_search(spark, sf, "nation_1"))


def cat_search_regex(spark, sf):
    return _flat(place_search(spark, sf, r"(7|asi)\D?$", regex=True))


def cat_listing(spark, sf):
    lines = list_tree(place_tree(spark, sf))
    return lines.select(path_text("path").alias("node"), "line")


def cat_ordinal_listing(spark, sf):
    """Siblings by rank instead of by name: orders by key below their customer."""
    levels = [Level("o_custkey", order="o_custkey"),
              Level("o_orderkey", "o_orderstatus", "o_orderkey")]
    lines = list_tree(build_tree(load(spark, sf, "orders"), levels))
    return lines.select(path_text("path").alias("node"), "line")


def _catalog_frames(spark, sf):
    """The two catalog views, derived from the tables: regions as schemas, nations as tables."""
    region, nation = load(spark, sf, "region"), load(spark, sf, "nation")
    nations = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    tables = nations.select(
        F.lit("world").alias("table_catalog"), F.col("r_name").alias("table_schema"),
        F.col("n_name").alias("table_name"))
    columns = load(spark, sf, "customer").join(
        nations, F.col("n_nationkey") == F.col("c_nationkey")
    ).where("c_acctbal > 0 or n_nationkey > 3").select(
        F.col("r_name").alias("table_schema"), F.col("n_name").alias("table_name"),
        F.col("c_name").alias("column_name"), F.lower("c_mktsegment").alias("column_type"),
        F.lower("c_mktsegment").alias("data_type"),
        F.when(F.col("c_acctbal") < 0, "NO").otherwise("YES").alias("is_nullable"))
    return tables, columns


def cat_mysql(spark, sf):
    return mysql_catalog(*_catalog_frames(spark, sf))


def cat_postgres(spark, sf):
    tables, columns = _catalog_frames(spark, sf)
    return postgres_catalog(tables, columns, database="world", schema="ASIA")


QUERIES = {
    f.__name__: f
    for f in (
        cat_tree, cat_search_sub, cat_search_upper, cat_search_regex, cat_listing,
        cat_ordinal_listing, cat_mysql, cat_postgres,
    )
}

NODES = """
with rows as (
  select r_name, n_name, c_name, '(' || c_mktsegment || ')' as note
  from nation join region on n_regionkey = r_regionkey
  left join customer on n_nationkey = c_nationkey),
nodes as (
  select distinct r_name as node, 1 as depth, r_name as name, null::varchar as description,
         r_name, null as n_name, null as c_name from rows
  union all
  select distinct r_name || '/' || n_name, 2, n_name, null, r_name, n_name, null from rows
  union all
  select r_name || '/' || n_name || '/' || c_name, 3, c_name, note, r_name, n_name, c_name
  from rows where c_name is not null)
"""


def search_sql(hit: str) -> str:
    return f"""{NODES}, hits as (select * from nodes where {hit})
        select node, depth, name, description from nodes n
        where exists (select 1 from hits h where h.node = n.node
                      or starts_with(h.node, n.node || '/'))"""


CATALOG_SQL = """
with tables as (
  select 'world' as table_catalog, r_name as table_schema, n_name as table_name
  from nation join region on n_regionkey = r_regionkey),
columns as (
  select r_name as table_schema, n_name as table_name, c_name as column_name,
         lower(c_mktsegment) as column_type,
         case when c_acctbal < 0 then 'NO' else 'YES' end as is_nullable
  from customer join nation on n_nationkey = c_nationkey join region on n_regionkey = r_regionkey
  where c_acctbal > 0 or n_nationkey > 3),
joined as (
  select t.*, c.column_name, c.column_type, c.is_nullable,
         '(' || c.column_type || case when c.is_nullable = 'NO' then ' NOT NULL' else '' end || ')'
         as description
  from tables t left join columns c
  on t.table_schema = c.table_schema and t.table_name = c.table_name)
"""

ORACLES = {
    "cat_tree": f"{NODES} select node, depth, name, description from nodes",
    "cat_search_sub": search_sql("contains(lower(name), 'er#00000007')"),
    "cat_search_upper": search_sql("contains(lower(name), 'nation_1')"),
    "cat_search_regex": search_sql(r"regexp_matches(name, '(7|asi)\D?$', 'i')"),
    "cat_listing": f"""{NODES}
        select node, repeat(' ', 4 * (depth - 1)) || name || coalesce(' ' || description, '')
               as line from nodes""",
    "cat_ordinal_listing": """
        select distinct o_custkey::varchar as node, o_custkey::varchar as line from orders
        union all
        select o_custkey || '/' || o_orderkey, '    ' || o_orderkey || ' ' || o_orderstatus
        from orders""",
    "cat_mysql": f"""{CATALOG_SQL} select table_schema, table_name, column_name, column_type,
        is_nullable, description from joined""",
    "cat_postgres": f"""{CATALOG_SQL} select * from joined
        where table_schema = 'ASIA' and table_catalog = 'world'""",
}
