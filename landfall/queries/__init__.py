"""All registered queries."""

from . import columns, jobs, rows  # noqa: F401
from .registry import ORACLE, QUERIES
