"""Schemaless items to document tables, once or continuously, on Spark."""

from itemflow.operators.convert import to_documents, typed_documents
from itemflow.operators.latest import latest_per_key
from itemflow.operators.route import to_operations
from itemflow.plans.jobs import (
    dry_run,
    migrate,
    migrate_all,
    replicate,
    replicate_all,
    status,
)
from itemflow.plans.ledger import Ledger
from itemflow.plans.pair import Mapping, Pair, RunSettings, Scan
from itemflow.sinks.table import DocTable
from itemflow.sources.changes import list_shards, parse_changes, read_change_lines, since
from itemflow.sources.items import scan_items

__all__ = [
    "DocTable",
    "Ledger",
    "Mapping",
    "Pair",
    "RunSettings",
    "Scan",
    "dry_run",
    "latest_per_key",
    "list_shards",
    "migrate",
    "migrate_all",
    "parse_changes",
    "read_change_lines",
    "replicate",
    "replicate_all",
    "scan_items",
    "since",
    "status",
    "to_documents",
    "to_operations",
    "typed_documents",
]
