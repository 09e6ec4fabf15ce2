"""papyra operators."""
