"""All registered queries and oracle SQL, merged from the domain modules."""

from __future__ import annotations

from netstream.plans import bit_plans, decay_plans, graph_plans, stream_plans


def all_queries() -> dict:
    out = {}
    out.update(graph_plans.QUERIES)
    out.update(decay_plans.QUERIES)
    out.update(bit_plans.QUERIES)
    out.update(stream_plans.QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    out.update(graph_plans.SQL)
    out.update(decay_plans.SQL)
    out.update(bit_plans.SQL)
    out.update(stream_plans.SQL)
    return out
