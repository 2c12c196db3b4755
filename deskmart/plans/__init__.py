"""Filter contexts, the measure registry and the report datasets."""
