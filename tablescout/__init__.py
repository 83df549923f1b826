"""Land, profile and relate tables at scale with plain Spark DataFrames."""

from tablescout.session import build_session

__all__ = ["build_session"]
