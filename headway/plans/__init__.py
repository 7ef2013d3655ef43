"""Models and reports: what is computed from the raw tables."""
