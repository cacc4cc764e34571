"""Package streaming."""
