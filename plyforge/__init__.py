"""Game archives to training data, and training reads, as Spark DataFrame jobs."""
