"""Layer plans: Silver, Gold, business questions and the pipeline."""
