"""Curation of annotated training sets on Spark."""
