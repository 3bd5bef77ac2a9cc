"""Scalar column expressions."""

from . import calendar, exprs, texts, units
