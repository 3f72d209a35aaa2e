"""The batch scorer over streams."""
