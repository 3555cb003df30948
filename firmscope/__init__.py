"""Company enrichment and text extraction as Spark DataFrame jobs."""
