"""Composed plans: the derived alert view, the consolidation pipelines, the registered queries."""
