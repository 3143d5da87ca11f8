"""Layer builders, gold queries and the layered run."""
