"""Streaming of the annotation-dataset engine."""
