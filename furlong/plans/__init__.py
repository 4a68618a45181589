"""Session settings and plan checks."""
