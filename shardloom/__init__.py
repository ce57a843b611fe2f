"""Spark-native operators for two-modality sample data that arrives as shards."""

from shardloom.session import build_session, durable, new_folder, shared_folder

__all__ = ["build_session", "durable", "new_folder", "shared_folder"]
