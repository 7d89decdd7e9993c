"""Scalar column expressions: time, cleaning, JSON and fixed values."""

from aerolith.functions import clean, constants, json, time

__all__ = ["clean", "constants", "json", "time"]
