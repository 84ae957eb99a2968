"""Operators of a training-data pipeline: filtering, deduplication, decontamination, scoring and token output."""
