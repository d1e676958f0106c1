from aisleworks.sources.csv_files import read_by_header, read_positional, read_with_rejects, split_rejects
from aisleworks.sources.listing import list_files
from aisleworks.sources.location import Location
from aisleworks.sources.published import NothingPublishedError, published_paths, read_published
from aisleworks.sources.tables import (
    RejectBudget, RejectBudgetError, load_table, load_with_rejects, read_split, read_table, register_views, replace_table,
)
from aisleworks.sources.tree import list_tree

__all__ = [
    "Location",
    "NothingPublishedError",
    "RejectBudget",
    "RejectBudgetError",
    "list_files",
    "list_tree",
    "load_table",
    "load_with_rejects",
    "published_paths",
    "read_by_header",
    "read_positional",
    "read_published",
    "read_split",
    "read_table",
    "read_with_rejects",
    "register_views",
    "replace_table",
    "split_rejects",
]
