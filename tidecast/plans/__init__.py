"""Registered queries, their SQL twins and the end-to-end job."""

from importlib import import_module

MODULES = ("queries_panel", "queries_features", "queries_metrics", "queries_anomaly", "queries_models", "queries_streams")


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"tidecast.plans.{name}")
