"""Reports over the star schema, and the batch run that builds it."""
