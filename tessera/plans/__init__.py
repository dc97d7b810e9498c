"""Fixture views and the registry of named queries."""

from . import (  # noqa: F401  (registers queries)
    q_columns, q_dictionary, q_distributions, q_groups, q_history, q_model, q_profile, q_sources,
    q_text,
)
from .registry import IDS, ORACLES, QUERIES  # noqa: F401
