"""Group-combat telemetry analytics as PySpark DataFrame operators."""

from emberlog.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
