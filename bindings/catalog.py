"""All registered queries."""

from bindings import changes, freight, live, retail, storage, themes  # noqa: F401
from bindings.register import ORACLES, QUERIES  # noqa: F401
