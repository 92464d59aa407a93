"""All queries over the driver's tables; importing this package registers them."""

from . import q_agg, q_bank, q_batch, q_dedup, q_keys, q_layout, q_regions, q_revisions, q_rulings, q_streams, q_text  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
