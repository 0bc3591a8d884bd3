"""headway.streaming."""
