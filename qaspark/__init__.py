"""Trend, tag-network and text-cluster analytics over Q&A posts, on Spark DataFrames."""

from qaspark.session import build_session, checkpoint_folder, write_through

__all__ = ["build_session", "checkpoint_folder", "write_through"]
