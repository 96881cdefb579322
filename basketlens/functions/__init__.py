"""Column expressions: text, casts, keys, predicates and masking. All run inside the JVM."""
