"""Column helpers and skew-safe ordering building blocks."""
