"""Reading and writing listing data."""
