"""Functions of the annotation-dataset engine."""
