from . import analytics, missing, modelling, preparation, pricing  # noqa: F401  (importing registers the queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
