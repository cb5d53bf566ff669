"""Compositions: the batch pipeline, the versioned metrics table, the SQL form."""
