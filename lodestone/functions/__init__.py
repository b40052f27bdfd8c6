"""Column-level helpers with PostgreSQL-compatible semantics."""
