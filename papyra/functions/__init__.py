"""papyra functions."""
