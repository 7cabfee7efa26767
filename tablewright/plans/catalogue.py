"""All queries in one place; importing the modules registers them."""

from . import fits, scores, stored, tables, trees  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
