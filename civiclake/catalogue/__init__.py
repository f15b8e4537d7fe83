"""Query catalogue: importing it registers every query."""

from . import lake, landing, parsing, relational, shaping  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
