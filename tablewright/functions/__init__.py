"""Names and column expressions."""
