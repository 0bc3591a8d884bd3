"""headway.operators."""
