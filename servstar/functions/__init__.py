"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from servstar.functions.expr import *  # noqa: F401,F403
from servstar.functions.expr import __all__  # noqa: F401
