"""Column-level helpers (no DataFrame actions)."""

from peerscope.functions.nulls import if_else, ratio, strict_mean, strict_sum, sum0  # noqa: F401
