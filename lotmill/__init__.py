"""lotmill: property-listing analytics expressed as Spark DataFrame jobs."""
