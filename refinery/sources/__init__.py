"""Schemas, the test projections, CSV ingest and table IO."""

from refinery.sources.fixtures import FIXTURES, bronze_inputs, fixture  # noqa: F401
from refinery.sources.schemas import SOURCES, SourceSpec  # noqa: F401
