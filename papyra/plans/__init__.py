"""papyra plans."""
