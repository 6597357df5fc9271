"""Event and dimension sources, and adapters from the test tables."""
