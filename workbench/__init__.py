"""Queries over the driver tables, each next to the SQL that states its answer."""

from workbench import deriving, describing, joining, jobs, ordering, publishing, scalars, scanning  # noqa: F401
from workbench.base import ORACLES, QUERIES  # noqa: F401
