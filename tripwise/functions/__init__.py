"""Column-level expressions: pure ``Column -> Column`` builders that stay
inside whole-stage codegen (no Python UDFs)."""
