"""Working, historical and quality tables."""
