"""The same upsert over files as they arrive."""
