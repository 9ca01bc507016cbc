"""Record linkage and citation enrichment as Spark DataFrame jobs."""
