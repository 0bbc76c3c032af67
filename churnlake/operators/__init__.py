"""DataFrame -> DataFrame jobs, one module per area of the pipeline."""
