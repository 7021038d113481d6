"""Registers all queries."""
from tallywatch.plans import q_marts, q_detect, q_facts, q_verdicts, q_gates, q_deep, q_metrics, q_sources  # noqa: F401
