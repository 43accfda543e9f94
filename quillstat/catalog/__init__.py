"""Named queries over the given tables, with their SQL counterparts."""

from quillstat.catalog.registry import REGISTRY, load_all

__all__ = ["REGISTRY", "load_all"]
