"""Column expressions: rules, JSON codec, time parsing, statistics."""
