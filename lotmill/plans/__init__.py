"""Star schema, summary marts and the refresh that builds them."""
