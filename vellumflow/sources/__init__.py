"""Tables and files."""
