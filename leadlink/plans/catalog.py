"""Every named query, grouped by module."""

from leadlink.plans import q_classify, q_core, q_dedup, q_flows, q_ingest, q_report, q_resolve, q_stream, q_text  # noqa: F401
from leadlink.plans.registry import ORACLES, QUERIES  # noqa: F401
