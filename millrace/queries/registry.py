"""All registered queries: importing the modules fills the registry."""

from millrace.queries import domain, files, increments, maintenance  # noqa: F401
from millrace.queries.support import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
