"""Registered queries and their SQL twins."""

from firnline.catalog import cleaning, files, models, places, profiles, quality  # noqa: F401
from firnline.catalog.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
