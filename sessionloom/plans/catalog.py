"""All queries of the library."""

from __future__ import annotations

from sessionloom.plans import landing, relations, research  # noqa: F401
from sessionloom.plans.registry import ORACLES, QUERIES  # noqa: F401
