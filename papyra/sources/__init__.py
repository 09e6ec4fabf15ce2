"""papyra sources."""
