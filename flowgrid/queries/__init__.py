"""The query registry behind ``__spark_entry__``."""

from flowgrid.queries import evaluate, explore, features, models, quality, series, tables  # noqa: F401
from flowgrid.queries.base import QUERIES, SQL  # noqa: F401
