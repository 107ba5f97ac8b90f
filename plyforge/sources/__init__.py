"""Archive and dataset readers, and the dataset and metrics writers."""
