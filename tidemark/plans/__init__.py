"""The warehouse, its nightly load and its report."""

from tidemark.plans.load import Bank, FrameBank, JdbcBank, run_backlog, run_load
from tidemark.plans.report import run_report
from tidemark.plans.store import Commit, ConcurrentLoadError, Warehouse

__all__ = [
    "Bank",
    "Commit",
    "ConcurrentLoadError",
    "FrameBank",
    "JdbcBank",
    "Warehouse",
    "run_backlog",
    "run_load",
    "run_report",
]
