"""Column -> Column functions and predicates (§2.4)."""

from cellar.functions.scalar import *  # noqa: F401,F403
from cellar.functions.predicates import *  # noqa: F401,F403
