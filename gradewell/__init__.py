"""Provider scorecards and data-quality profiling as Spark jobs."""
