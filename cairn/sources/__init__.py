"""Sources of the annotation-dataset engine."""
