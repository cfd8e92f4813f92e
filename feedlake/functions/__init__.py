"""Scalar column expressions (built-in functions only)."""

from feedlake.functions.columns import *  # noqa: F401,F403
