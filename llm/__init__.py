"""Operators for large training-corpus pipelines.  Nothing else in this repository imports this package."""
