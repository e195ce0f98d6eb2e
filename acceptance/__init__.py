"""Acceptance queries: the operators run over whole sample tables, and the SQL they match."""
