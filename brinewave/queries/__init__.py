"""Named queries over the driver tables, each with the SQL that checks it."""

from importlib import import_module

MODULES = ["catch", "ocean", "lice", "lengths", "files", "verbs"]


def load():
    for name in MODULES:
        import_module(f"brinewave.queries.{name}")
    registry = import_module("brinewave.queries.registry")
    return dict(sorted(registry.QUERIES.items())), dict(sorted(registry.ORACLES.items()))
