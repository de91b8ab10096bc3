"""Named queries over the standard tables, grouped by area."""

from importlib import import_module

AREAS = ["quality", "access", "series", "metadata", "catalog", "sources", "lineage", "streaming"]


def load_all() -> None:
    """Import every area so that its queries register themselves."""
    for area in AREAS:
        import_module(f"assetlake.plans.{area}")
