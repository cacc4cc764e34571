"""Package functions."""
