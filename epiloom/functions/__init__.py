"""Column-level helpers: sequences, methylation sites, rates."""
