"""Whole jobs composed of the operators, and the query registry."""


def load_queries():
    """All registered queries by name."""
    from formspark.plans import queries  # noqa: F401
    from formspark.plans.registry import QUERIES

    return QUERIES
