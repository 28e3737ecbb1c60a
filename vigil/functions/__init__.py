"""Column -> Column functions."""
from vigil.functions import conditions, ids, rules, strings, times  # noqa: F401
