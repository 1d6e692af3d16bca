"""Registered queries: one per operator, each over whole tables, with its SQL counterpart."""

from rowferry.plans import catalogs, scalars, sinks, sources, sqltext, types

GROUPS = (scalars, types, sources, sinks, catalogs, sqltext)


def all_queries():
    return {name: query for group in GROUPS for name, query in group.QUERIES.items()}


def all_oracles():
    return {name: sql for group in GROUPS for name, sql in group.ORACLES.items()}
