"""Column-level helpers: every function returns a Spark ``Column`` built from
built-in expressions, so all of it stays inside whole-stage codegen."""
