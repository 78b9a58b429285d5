"""Named queries over the test tables, each with the SQL that must give the same rows."""

from estrato.catalog import (  # noqa: F401  (importing a module registers its queries)
    changes, checks, fraud, gold, ingest, io, quality, relational, runs,
)
from estrato.catalog.registry import REGISTRY  # noqa: F401
