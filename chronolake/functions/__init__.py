"""Column-level building blocks: entity specs, derived-column rules, row hashes."""
