"""File-stream jobs."""
