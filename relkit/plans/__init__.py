"""Query catalogue: importing this package registers every query."""

from . import relational  # noqa: F401
from .registry import FAMILIES, ORACLES, QUERIES  # noqa: F401

for _mod in ("analytics", "maintenance", "storage", "streams"):
    try:
        __import__(f"{__name__}.{_mod}")
    except ModuleNotFoundError as exc:  # modules are added incrementally
        if exc.name != f"{__name__}.{_mod}":
            raise
