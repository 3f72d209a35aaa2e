"""Column functions: no actions, no shuffles."""
