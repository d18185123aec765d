"""Jobs and the registered queries."""

from . import catalog_queries, diff_queries, nested_queries, page_queries, text_queries  # noqa: F401
from .registry import QUERIES  # noqa: F401
