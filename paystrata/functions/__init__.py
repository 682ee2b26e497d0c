"""Column expressions. Everything here is built in: no Python runs per row."""
