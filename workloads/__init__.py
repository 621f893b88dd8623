"""The library's operators applied to the test tables, each beside its SQL."""

from importlib import import_module

MODULES = ("loading", "shaping", "facts", "geography", "answers", "checks")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"workloads.{name}")
