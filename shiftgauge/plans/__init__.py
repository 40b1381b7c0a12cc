"""The user-facing queries."""
