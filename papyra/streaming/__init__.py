"""papyra streaming."""
