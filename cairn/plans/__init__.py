"""Plans of the annotation-dataset engine."""
