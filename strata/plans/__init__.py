"""Composed jobs: entity configs, the pipeline, and the query registry."""
