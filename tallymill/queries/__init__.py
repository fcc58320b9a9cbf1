"""Named queries over the test tables."""

from tallymill.queries import basic, changes, sales, stored  # noqa: F401
from tallymill.queries.registry import ORACLES, QUERIES  # noqa: F401
