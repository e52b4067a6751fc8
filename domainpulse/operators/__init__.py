"""DataFrame -> DataFrame operators of the health pipeline."""
