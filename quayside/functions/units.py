"""Unit conversion and classification expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import ColumnOrName, c

# Length unit -> (operation, operand) giving centimetres; any other unit is cm.
LENGTH_TO_CM = [("MM", "/", 10), ("M", "*", 100), ("IN", "*", 2.54)]
# Weight unit codes.
GRAMS = "G"
KILOGRAMS = "KG"


def length_cm(value: ColumnOrName, unit: ColumnOrName) -> Column:
    """MM / 10, M * 100, IN * 2.54, any other unit (or NULL) unchanged."""
    v, u = c(value), c(unit)
    expr = None
    for code, op, operand in LENGTH_TO_CM:
        term = v / operand if op == "/" else v * operand
        expr = F.when(u == code, term) if expr is None else expr.when(u == code, term)
    return expr.otherwise(v)


def grams_to_kg(value: ColumnOrName, unit: ColumnOrName) -> Column:
    """Weight in kilograms when given in grams, else unchanged."""
    return F.when(c(unit) == GRAMS, c(value) / 1000).otherwise(c(value))


def kg_to_grams(value: ColumnOrName, unit: ColumnOrName) -> Column:
    """Piece weight in grams when given in kilograms, else unchanged."""
    return F.when(c(unit) == KILOGRAMS, c(value) * 1000).otherwise(c(value))


def ordered_rules(rules: Sequence[tuple[Column, str | None]], default: str | None) -> Column:
    """First matching rule wins; a rule value of ``None`` yields NULL."""
    expr = None
    for cond, value in rules:
        v = F.lit(value).cast("string")
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(F.lit(default).cast("string")) if expr is not None else F.lit(default)


# Fixed value: the brand classified DRY whatever its technology in the original rules.
DRY_BRANDS = ("DREAMIES",)


def technology_rules(brand: ColumnOrName = "Brand", technology: ColumnOrName = "Technology",
                     dry_brands: Sequence[str] = DRY_BRANDS) -> list[tuple[Column, str | None]]:
    """C5 rule list: brand override, then technology names, NULL stays NULL.

    Fixed values: 'Dry' and 'Care & Treats' are DRY, 'Pouch' is WET.
    """
    b, t = c(brand), c(technology)
    return [
        (b.isin(*dry_brands), "DRY"),
        (t == "Dry", "DRY"),
        (t == "Care & Treats", "DRY"),
        (t == "Pouch", "WET"),
        (t.isNull(), None),
    ]
