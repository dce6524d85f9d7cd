"""The reader-analytics jobs."""
