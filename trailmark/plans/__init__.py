"""Registered queries; importing this package registers all of them."""

from . import exploration_queries, journey_queries, mining_queries, model_queries, serving_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
