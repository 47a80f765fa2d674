"""Jobs: each builds one table from its input tables."""
