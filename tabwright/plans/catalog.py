"""Imports every plan module, which registers its queries."""

from tabwright.plans import closed, encoders, evaluate, fitted, forests, machines, nearest, paths, prepare, texts  # noqa: F401
from tabwright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
