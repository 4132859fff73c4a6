"""Column-level helpers: parsing, validation, latencies, presentation."""
