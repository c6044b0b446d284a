"""Registered queries of the lifecycle engine and their SQL."""

from __future__ import annotations

from tidemark.plans import adapter_plans, builder_plans, entity_plans, events_plans, markup_plans, more_plans, page_plans, run_plans, source_plans, state_plans, table_plans

FLAGSHIP = "lifecycle"
MODULES = (events_plans, page_plans, entity_plans, source_plans, more_plans, table_plans, state_plans, builder_plans, adapter_plans, run_plans, markup_plans)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items() if s}
