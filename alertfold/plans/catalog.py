"""Import every query module once and expose the registry."""

from __future__ import annotations


def all_queries():
    from alertfold.plans import q_core  # noqa: F401
    from alertfold.plans import q_files  # noqa: F401
    from alertfold.plans import q_outputs  # noqa: F401
    from alertfold.plans import q_stream  # noqa: F401
    from alertfold.plans.registry import QUERIES
    return QUERIES
