"""Incremental scoring of newly arriving rows with frozen, fitted state."""
