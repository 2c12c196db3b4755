"""Support-ticket analytics expressed as Spark DataFrame jobs."""
