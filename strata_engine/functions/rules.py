"""Rule builders. A rule set is ``dict[name, SQL boolean expression]``.

A row passes a rule only when the expression is TRUE; NULL counts as a
failure (the same as a plain ``WHERE``). Every builder returns a fresh dict so
rule sets compose with ``{**a, **b}``.
"""

from __future__ import annotations

from collections.abc import Iterable


def _q(col: str) -> str:
    return f"`{col}`"


def in_range_or(col: str, low: float, sentinel: float, name: str | None = None) -> dict[str, str]:
    """``col >= low`` or equal to the sentinel (e.g. ``-9`` = missing)."""
    return {name or f"non_negative_{col.lower()}": f"{_q(col)} >= {low} OR {_q(col)} = {sentinel}"}


# Inclusive bounds of the integral cast targets that can overflow.
_INT_TARGETS = {
    "TINYINT": (-128, 127),
    "SMALLINT": (-32768, 32767),
    "INT": (-2147483648, 2147483647),
    "INTEGER": (-2147483648, 2147483647),
}


def lossless_cast(col: str, to: str, name: str | None = None) -> dict[str, str]:
    """Casting the (numeric) column to ``to`` keeps the value; an
    out-of-range value fails the rule. For integral targets a range check
    comes first (AND short-circuits), so overflowing values never reach
    ``try_cast``'s per-row exception path."""
    q = _q(col)
    check = f"try_cast({q} AS {to}) = {q}"
    bounds = _INT_TARGETS.get(to.strip().upper())
    if bounds is not None:
        lo, hi = bounds
        check = f"{q} > {lo - 1} AND {q} < {hi + 1} AND {check}"
    return {name or f"valid_{col.lower()}_type": check}


def default_bound_name(col: str) -> str:
    """``EDUC`` → ``valid_educ_values``."""
    return f"valid_{col.lower()}_values"


def at_least(cols: Iterable[str], low: float, names: dict[str, str] | None = None) -> dict[str, str]:
    """One lower-bound rule per column; ``names`` overrides rule names."""
    names = names or {}
    return {names.get(c, default_bound_name(c)): f"{_q(c)} >= {low}" for c in cols}


def not_null(cols: Iterable[str]) -> dict[str, str]:
    return {f"valid_{c.lower()}": f"{_q(c)} IS NOT NULL" for c in cols}


def not_blank(col: str, name: str | None = None) -> dict[str, str]:
    """Not NULL and not the empty string."""
    return {name or f"valid_{col.lower()}": f"{_q(col)} IS NOT NULL AND {_q(col)} != ''"}


def conjunction(rules: dict[str, str]) -> str:
    """All rules AND-ed; each is parenthesised since some contain OR."""
    if not rules:
        return "TRUE"
    return " AND ".join(f"({r})" for r in rules.values())
