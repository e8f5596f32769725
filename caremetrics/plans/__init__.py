"""Registry of named queries and their SQL twins."""
