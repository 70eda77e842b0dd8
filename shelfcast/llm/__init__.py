"""Operators of a training-data pipeline: quality, dedup, extraction, filtering, scoring, mixing, output."""
