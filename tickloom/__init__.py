"""Market-data analytics as plain DataFrame functions on Spark."""

from tickloom.session import build_session, workspace

__all__ = ["build_session", "workspace"]
