"""DataFrame -> DataFrame operators."""
from vigil.operators import (aggregate, collapse, columns, dedup, geo, impute, joins,  # noqa: F401
                             places, tables, text)
