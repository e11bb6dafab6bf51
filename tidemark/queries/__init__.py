"""All registered queries."""

from tidemark.queries import dimensions, edits, prices, streams, text  # noqa: F401
from tidemark.queries.registry import QUERIES, SQL  # noqa: F401
