"""All queries and oracles."""

from meridian.plans import filters, maps, nearness, places, polygons, raster, reports  # noqa: F401
from meridian.plans.queries import ORACLES, QUERIES  # noqa: F401
