"""All named queries."""

from importlib import import_module

from tapeloom.plans.registry import PLANS

MODULES = ["ingest", "projections", "titles", "joins", "series", "aggregates", "vectors", "features", "evaluation"]

for _module in MODULES:  # importing a module registers its queries
    import_module(f"{__name__}.{_module}")

__all__ = ["PLANS"]
