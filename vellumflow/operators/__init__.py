"""DataFrame operators over the workflow tables."""
