"""Commerce warehouse operators as DataFrame functions on Spark."""
