"""Every checked query, by inventory section."""

from importlib import import_module

SECTIONS = ("functions", "classify", "views", "reports", "relational", "landing", "dedupe", "streams", "documents", "allocations", "readers", "grants", "dispatch")


def load() -> None:
    for s in SECTIONS:
        import_module(f"obolus.catalog.{s}")
