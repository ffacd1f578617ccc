"""Column-level building blocks: time conversion, event parsing, region lookup."""
