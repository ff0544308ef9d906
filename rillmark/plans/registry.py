"""All registered queries of the library's own operators, with their SQL."""

from __future__ import annotations

from . import city, geometry, lineage, streets, terrain

QUERIES = {**geometry.QUERIES, **terrain.QUERIES, **streets.QUERIES, **city.QUERIES, **lineage.QUERIES}
ORACLES = {**geometry.ORACLES, **terrain.ORACLES, **streets.ORACLES, **city.ORACLES, **lineage.ORACLES}
FLAGSHIP = "s3_street_index"
