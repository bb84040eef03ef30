"""Registered queries: each pairs a Spark callable with its SQL twin, if it has one."""

from registry.base import QUERIES, SQL
from registry import (  # noqa: F401
    features, profiles, evaluation, rules, models, streams,
)

__all__ = ["QUERIES", "SQL"]
