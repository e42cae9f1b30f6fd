"""Queries over the supplied tables; importing this package fills the registry."""

from importlib import import_module

from .registry import QUERIES, SQL  # noqa: F401

for _name in ("text_queries", "window_queries", "join_queries", "search_queries", "curation_queries", "fold_queries", "variant_queries", "source_queries", "dictionary_queries"):
    import_module(f"{__name__}.{_name}")
