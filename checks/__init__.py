"""Registered queries over the given tables, each with the SQL that states the same result."""

from importlib import import_module

MODULES = ("q_sources", "q_delta", "q_aggregate", "q_physics", "q_spatial", "q_compare")


def load():
    """(queries, sql) of all modules."""
    from checks import registry

    for name in MODULES:
        import_module(f"checks.{name}")
    return registry.QUERIES, registry.SQL
