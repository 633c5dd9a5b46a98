"""Import every query module and expose the registry."""

from . import q_cells, q_reads, q_saturation, q_scan, q_sites, q_sources, q_summary  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
