"""Dataset operators built from DataFrame operations."""
