"""Part of the annotation engine."""
