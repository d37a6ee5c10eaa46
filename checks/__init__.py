"""Queries over the driver tables and the SQL they are compared with."""

from importlib import import_module

CATALOGS = ("catalog_counts", "catalog_sources", "catalog_regions", "catalog_scoring", "catalog_fastq")


def load_all() -> None:
    """Import every catalog, which registers its queries."""
    for name in CATALOGS:
        import_module(f"checks.{name}")
