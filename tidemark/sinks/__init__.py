"""Writing lake tables and SQL tables."""
