"""Registered queries and their oracles."""

from airshed.registry import cleaning, effects, landing, profiling, scoring  # noqa: F401
from airshed.registry.core import REGISTRY, oracle_queries, spark_queries  # noqa: F401
