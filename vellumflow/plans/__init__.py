"""Composites: whole batches of the extract, summarize and upload work."""
