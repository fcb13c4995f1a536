"""Scalar Column builders: log parsing, time helpers, formatting."""

from daybook.functions import fmt, parse, time

__all__ = ["fmt", "parse", "time"]
