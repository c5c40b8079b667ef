"""All checked queries; importing the modules registers them."""

from tidemark.catalog import columns, days, hierarchy, money, quality, reconciliation, sources  # noqa: F401
from tidemark.catalog.registry import ORACLES, QUERIES  # noqa: F401
