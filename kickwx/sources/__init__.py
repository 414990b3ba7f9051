"""Bronze sources: schemas, file and table readers, payload unnesting."""
