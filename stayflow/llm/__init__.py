"""Operators for building training corpora: near-duplicates, quality, packing, tokens, chat and URL rules.

Nothing else in the library imports this subpackage. ``queries()`` and ``oracle_sql()`` list what it registers.
"""

from __future__ import annotations


def queries() -> dict:
    from stayflow.llm import registry

    return dict(registry.SPARK)


def oracle_sql() -> dict:
    from stayflow.llm import registry

    return dict(registry.ORACLE)
