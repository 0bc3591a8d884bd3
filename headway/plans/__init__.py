"""headway.plans."""
