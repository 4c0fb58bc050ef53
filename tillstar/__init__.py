"""Retail sales warehouse as Spark jobs: raw, staging, audit and star-schema layers."""

__version__ = "0.1.0"
