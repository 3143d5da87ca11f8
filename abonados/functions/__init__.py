"""Column functions. Every one returns a Column that Catalyst sees through."""
