"""Named queries over the test tables, each with its SQL oracle where SQL can express it."""

from presslens.catalog.registry import ORACLES, QUERIES  # noqa: F401
from presslens.catalog import (  # noqa: F401  (registration)
    audience,
    crm,
    daily,
    models,
    rolling,
    storage,
)
