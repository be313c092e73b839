"""All registered queries and their checking SQL."""

from barloom.catalog import basics, ingest_rows, master_rows, products, regime_rows, technical  # noqa: F401
from barloom.catalog.kit import ORACLES, QUERIES  # noqa: F401
