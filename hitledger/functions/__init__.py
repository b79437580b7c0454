"""Column-level building blocks: log layout, parsing rules, addresses, hashing, units."""
