"""Event and change-data analytics on Spark tables and streams."""

from eventlake.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
