"""Column expressions: names, schema references, typed text, strict JSON."""
