"""Training, evaluation and comparison jobs."""
