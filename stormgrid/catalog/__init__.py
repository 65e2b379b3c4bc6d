"""All named queries."""

from stormgrid.catalog import expressions, files, fits, models, ordering, relational, selected, spread, state, streams, weather  # noqa: F401
from stormgrid.catalog.registry import REGISTRY  # noqa: F401
