"""Readers: files, run statistics, documents and the scheduler's metadata."""
