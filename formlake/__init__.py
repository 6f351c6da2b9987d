"""Research-project exports as Spark DataFrames: land, narrow, label, split, export."""

from formlake.operators.forms import single_form, split_forms, split_forms_labeled
from formlake.operators.labels import label
from formlake.operators.narrowing import narrow, profile_types
from formlake.plans.ingest import TransferResult, ingest, retry_failed
from formlake.project import Project
from formlake.sinks.inspect import inspect
from formlake.sinks.parquet import save_parquet
from formlake.sources.projects import FolderSource, RequestSource, TableSource
from formlake.sources.transport import ExportOptions, FormPost

__all__ = [
    "ExportOptions",
    "FolderSource",
    "FormPost",
    "Project",
    "RequestSource",
    "TableSource",
    "TransferResult",
    "ingest",
    "inspect",
    "label",
    "narrow",
    "profile_types",
    "retry_failed",
    "save_parquet",
    "single_form",
    "split_forms",
    "split_forms_labeled",
]
