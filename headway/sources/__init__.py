"""headway.sources."""
