"""Health-service reporting analytics expressed as Spark plans."""
