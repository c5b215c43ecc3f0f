"""A PostgreSQL-style SQL subset over collections."""
