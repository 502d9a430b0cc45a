"""Column expressions shared by the operators. Everything here stays inside whole-stage codegen."""
