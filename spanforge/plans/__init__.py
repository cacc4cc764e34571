"""Package plans."""
