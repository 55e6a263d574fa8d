"""Operators of the annotation-dataset engine."""
