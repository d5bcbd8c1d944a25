"""Registered queries by family; importing the package registers all of them."""

from formspark.plans.queries import (  # noqa: F401
    answers,
    auditing,
    forms,
    grading,
    intake,
    measures,
    reading,
    texts,
)
