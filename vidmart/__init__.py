"""vidmart: a short-video analytics mart written as PySpark DataFrame jobs."""
