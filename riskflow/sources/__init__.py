"""Tables, models and the registry on shared storage."""
