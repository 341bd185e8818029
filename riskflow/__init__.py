"""riskflow: card-payment risk analytics written as Spark DataFrame and streaming jobs."""

from riskflow.session import build_session, configure, work_dir

__all__ = ["build_session", "configure", "work_dir"]
