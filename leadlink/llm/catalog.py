"""Every named query of this subpackage."""

from leadlink.llm import decontaminate, exact_dedup, hard_negatives, language_id, merkle, near_dedup, packing, pii, quality, simhash, token_counts, token_orc, warc  # noqa: F401
from leadlink.llm.registry import ORACLES, QUERIES  # noqa: F401
