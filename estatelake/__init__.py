"""estatelake: listing-snapshot analytics expressed as Spark DataFrame jobs."""
