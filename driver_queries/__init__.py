"""Queries over the driver's tables, each with the SQL that checks it."""

from . import fixtures, judging, preferences, prompts, reports, texts  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
