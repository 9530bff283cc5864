"""Every operator as a query over the given tables, beside its oracle SQL."""

from __future__ import annotations


def _modules():  # noqa: ANN202
    from checks import catalog_checks, measure_checks, text_checks

    return catalog_checks, text_checks, measure_checks


def all_checks() -> dict:
    return {name: fn for m in _modules() for name, fn in m.CHECKS.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.SQL.items()}
