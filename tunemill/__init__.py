"""Training and evaluation data for fine-tuning, prepared with PySpark."""

from tunemill.plans.recipe import EvaluationItem, Recipe
from tunemill.session import get_session
from tunemill.sources.datasets import Library, scan

__all__ = ["EvaluationItem", "Library", "Recipe", "get_session", "scan"]
