"""Warehouse history, incremental loading and fraud reporting on Spark."""
