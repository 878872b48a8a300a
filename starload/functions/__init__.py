"""Scalar column functions (JVM-side built-ins only)."""

from starload.functions.expr import *  # noqa: F401,F403
