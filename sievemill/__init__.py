"""Tabular ingestion, data quality and repeatable loading on Spark."""

from sievemill.operators.tables import Warehouse
from sievemill.plans.ingest import IngestRun, ingest_files, ingest_folder
from sievemill.registry import ColumnSpec, Registry, SchemaSpec, build_registry, load_registry
from sievemill.session import get_session

__all__ = [
    "ColumnSpec", "IngestRun", "Registry", "SchemaSpec", "Warehouse", "build_registry", "get_session",
    "ingest_files", "ingest_folder", "load_registry",
]
