"""Plans: the cleaning jobs, gold products, reconciliation, the pipeline, and the
registered query catalogue with its SQL oracle."""
