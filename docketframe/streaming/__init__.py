"""The same work on pages as they land."""
