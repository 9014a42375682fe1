"""DataFrame -> DataFrame operators; see the survey's inventory IDs in each docstring."""
