"""Catalogs and hierarchies on small trees, checked against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from rowferry import Engine
from rowferry.operators.catalog import (
    mysql_catalog,
    postgres_catalog,
    schema_levels,
    spark_catalog,
)
from rowferry.operators.hierarchy import Level, build_tree, list_tree, path_text, search_tree
from rowferry.operators.joins import left_join_all
from rowferry.plans.catalogs import nations, place_levels, place_search, place_tree
from rowferry.plans.tables import load

ROWS = [
    ("Alpha", "users", "id", "(int)"), ("Alpha", "users", "Name", "(text)"),
    ("Alpha", "orders", "id", "(int)"), ("beta", "users", "id", "(int)"),
    ("beta", "empty", None, None), ("gamma", "log", "USER_ID", "(int)"), ("delta", None, None, None),
]
LEVELS = [Level("l1"), Level("l2"), Level("l3", "description")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "l1 string, l2 string, l3 string, description string").repartition(3)


def all_paths():
    found = set()
    for *names, _ in ROWS:
        for depth in range(1, 4):
            if None not in names[:depth]:
                found.add(tuple(names[:depth]))
    return found


def kept(hit):
    paths = all_paths()
    return {p for p in paths if any(q[:len(p)] == p and hit(q[-1]) for q in paths)}


def paths_of(nodes):
    return [tuple(step.name for step in r.path) for r in nodes.collect()]


def test_build(rows):
    found = paths_of(build_tree(rows, LEVELS))
    assert len(found) == len(set(found)) and set(found) == all_paths()


@pytest.mark.parametrize("query", ["user", "ID", "alpha", "nothing", "a", "log"])
def test_search(rows, query):
    found = paths_of(search_tree(rows, LEVELS, query))
    assert set(found) == kept(lambda name: query.lower() in name.lower()) and len(found) == len(set(found))


@pytest.mark.parametrize("pattern", [r"^u", r"\D", r"r.*_id$", "[ae]lpha|log"])
def test_search_regex(rows, pattern):
    found = paths_of(search_tree(rows, LEVELS, pattern, regex=True))
    assert set(found) == kept(lambda name: re.search(pattern, name, re.I))


def test_listing(rows):
    lines = [r.line for r in list_tree(build_tree(rows, LEVELS)).collect()]
    assert lines == [
        "Alpha", "    orders", "        id (int)", "    users", "        Name (text)", "        id (int)",
        "beta", "    empty", "    users", "        id (int)", "delta", "gamma", "    log",
        "        USER_ID (int)"]


def test_listing_by_rank(spark):
    df = spark.createDataFrame([("t", "b", 0), ("t", "a", 1)], "t string, c string, n int")
    lines = list_tree(build_tree(df, [Level("t"), Level("c", order="n")])).collect()
    assert [r.line for r in lines] == ["t", "    b", "    a"]


def test_upper_description_is_one_per_node(spark):
    df = spark.createDataFrame([("t", "y", "a"), ("t", "x", "b")], "t string, d string, c string")
    nodes = build_tree(df, [Level("t", "d"), Level("c")])
    assert {(r.name, r.description) for r in nodes.collect()} == {("t", "x"), ("a", None), ("b", None)}


def test_single_level(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "n string")
    assert [r.line for r in list_tree(build_tree(df, [Level("n")])).collect()] == ["a", "b"]


def test_leaves_are_not_shuffled(rows):
    """Only the distinct upper nodes are exchanged."""
    plan = build_tree(rows, LEVELS)._jdf.queryExecution().executedPlan().toString()
    upper, leaves = plan.split("\n+- Union" if "\n+- Union" in plan else "Union")[-1].split("\n   +- ", 1)
    assert upper.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in plan
    assert "Exchange hashpartitioning" not in leaves and "Aggregate" not in leaves


def frames(spark):
    tables = spark.createDataFrame(
        [("db", "s1", "t"), ("db", "s1", "bare"), ("db", "public", "t"), ("other", "public", "u")],
        "table_catalog string, table_schema string, table_name string")
    columns = spark.createDataFrame(
        [("s1", "t", "a", "int", "NO"), ("s1", "t", "b", "text", "YES"), ("public", "t", "c", "int", "YES"),
         ("gone", "x", "y", "int", "NO")],
        "table_schema string, table_name string, column_name string, column_type string, is_nullable string")
    return tables, columns


def test_mysql_catalog(spark):
    tables, columns = frames(spark)
    found = {(r.table_schema, r.table_name, r.column_name, r.description)
             for r in mysql_catalog(tables, columns).collect()}
    assert found == {("s1", "t", "a", "(int NOT NULL)"), ("s1", "t", "b", "(text)"),
                     ("s1", "bare", None, None), ("public", "t", "c", "(int)"), ("public", "u", None, None)}
    assert mysql_catalog(tables, columns, "s1").count() == 3
    lines = list_tree(build_tree(mysql_catalog(tables, columns, "s1"), schema_levels())).collect()
    assert [r.line for r in lines] == ["s1", "    bare", "    t", "        a (int NOT NULL)", "        b (text)"]


def test_postgres_catalog(spark):
    tables, columns = frames(spark)
    columns = columns.withColumnRenamed("column_type", "data_type")
    rows = postgres_catalog(tables, columns, database="db").collect()
    assert [(r.table_catalog, r.table_name, r.column_name) for r in rows] == [("db", "t", "c")]


def test_spark_catalog_search(spark):
    engine = Engine(spark)
    engine.register_tables("/root/testdata/sf0.001", ["nation", "region"])
    nodes = engine.tree(spark_catalog(spark), schema_levels(), "n_name")
    lines = [r.line for r in engine.listing(nodes).collect()]
    assert "    nation" in lines and "        n_name (string)" in lines and "    region" not in lines
    assert path_text(F.col("path")) is not None


def scans(df, column):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len([line for line in plan.splitlines() if "Relation" in line and column in line])


def places(spark, folder):
    """One row per customer; a nation without any keeps its row."""
    customer = load(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return left_join_all(nations(spark, folder), customer, ["n_nationkey"])


def test_upper_frame_reads_the_large_table_once(spark):
    folder = "/root/testdata/sf0.001"
    tree = place_tree(spark, folder)
    assert scans(tree, "c_name") == 1
    whole = build_tree(places(spark, folder), place_levels())
    assert sorted(map(str, tree.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("query, regex", [("1", False), ("nation_1", False), (r"(7|asi)\D?$", True), ("nothing at all", False)])
def test_search_reads_the_large_table_once(spark, query, regex):
    folder = "/root/testdata/sf0.001"
    found = place_search(spark, folder, query, regex)
    assert scans(found, "c_name") == 1
    whole = search_tree(places(spark, folder), place_levels(), query, regex)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_search_keeps_equal_leaves_and_one_upper_description(spark):
    rows = spark.createDataFrame([("a", "x", "2"), ("a", "x", "1"), ("b", "x", None), ("b", "y", "3")], "u string, l string, d string")
    levels = [Level("u", "d"), Level("l", "d")]
    found = [(paths_of(search_tree(rows, levels, q)), search_tree(rows, levels, q)) for q in ("x", "a")]
    assert sorted(found[0][0]) == [("a",), ("a", "x"), ("a", "x"), ("b",), ("b", "x")]
    assert found[1][0] == [("a",)] and found[1][1].first().description == "1"
