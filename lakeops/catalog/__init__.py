"""All registered queries; importing the package fills the registry."""

import importlib

from lakeops.catalog.base import COVERS, ORACLE, QUERIES

MODULES = (
    "scans", "sinks", "projections", "relational", "windowed", "scalars", "streams", "series", "retrieval", "insurance",
)
for _name in MODULES:
    importlib.import_module(f"lakeops.catalog.{_name}")

__all__ = ["COVERS", "ORACLE", "QUERIES"]
