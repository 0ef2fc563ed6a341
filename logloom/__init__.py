"""Log normalisation, document scans, dataset building and evaluation as Spark DataFrame jobs."""
