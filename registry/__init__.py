"""Registered queries: the library's operators over the driver tables, with SQL twins."""
