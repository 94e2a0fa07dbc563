"""Raw tables to canonical extracts, and generic readers."""
