"""Registered queries and their oracles."""

from . import catalogue, extended, streams  # noqa: F401  the others add their queries to the first's registry
