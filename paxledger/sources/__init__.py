"""Reading, writing and describing the check-in tables."""
