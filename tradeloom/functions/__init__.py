"""Column-level building blocks.  All of them stay inside whole-stage code generation."""
