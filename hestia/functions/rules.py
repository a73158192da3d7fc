"""Declarative cleaning rules: cascades, bins and null fills as Columns.

Rules are data (lists of conditions/values, band edges, mappings); these
helpers turn them into one ``CASE WHEN`` expression each, which Catalyst
constant-folds and codegen evaluates in a single pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from hestia.functions.text import ColumnOrName, _c, any_contains


def cascade(rules: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """First matching rule wins; ``default`` (value or Column) otherwise."""
    out = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if out is None:
        return default if isinstance(default, Column) else F.lit(default)
    d = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(d)


def bin_labels(col: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for ``col < edges[i]`` (first match), else the last
    label. A null value falls through to the last label, as in the rules
    this mirrors."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = _c(col)
    rules = [(c < F.lit(e), lab) for e, lab in zip(edges, labels)]
    return cascade(rules, labels[-1])


def fill_from(col: ColumnOrName, other: ColumnOrName) -> Column:
    """Null → value of another column."""
    return F.coalesce(_c(col), _c(other))


def fill_by_category(col: ColumnOrName, category: ColumnOrName, mapping: Mapping[Any, Any]) -> Column:
    """Null → constant chosen by category (unknown category stays null)."""
    c, k = _c(col), _c(category)
    by_cat = cascade([(k == key, value) for key, value in mapping.items()], None)
    return F.when(c.isNull(), by_cat).otherwise(c)


def fill_by_keywords(col: ColumnOrName, text: ColumnOrName, needles: Sequence[str], value: Any) -> Column:
    """Null → ``value`` when the lower-cased text contains a needle."""
    c = _c(col)
    hit = any_contains(F.lower(_c(text)), needles)
    return F.when(c.isNull() & hit, F.lit(value)).otherwise(c)
