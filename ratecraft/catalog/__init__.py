"""Every operator of the inventory as a named query over the test tables."""

from ratecraft.catalog import scans, columns, joins, groups, ranks, functions, samples, measures, models, certain  # noqa: F401
from ratecraft.catalog.registry import BUILDERS, ORACLES

__all__ = ["BUILDERS", "ORACLES"]
