"""Market-publication analytics expressed as Spark DataFrame operators."""

from tapeworks.session import build_session, configure, workspace

__all__ = ["build_session", "configure", "workspace"]
