"""Column-level helpers: tolerant typing, text cleaning and predicates."""

from sluice.functions.scalars import *  # noqa: F401,F403
from sluice.functions.predicates import *  # noqa: F401,F403
