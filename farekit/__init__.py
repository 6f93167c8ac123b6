"""farekit: fare analytics and price modelling as Spark DataFrame operators."""

from farekit.session import build_session, shared_dir, stage

__all__ = ["build_session", "shared_dir", "stage"]
