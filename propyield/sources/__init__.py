from propyield.sources.delimited import (
    ingest_folder,
    ingest_pipe_folder,
    ingest_yearly_folder,
    read_delimited,
    read_header,
    read_tolerant,
    rename_columns,
    scan_with_rejects,
)
from propyield.sources.headers import HeaderGroup, file_parts, header_groups
from propyield.sources.inference import infer_types

__all__ = [
    "HeaderGroup", "file_parts", "header_groups", "infer_types",
    "ingest_folder", "ingest_pipe_folder", "ingest_yearly_folder", "read_delimited",
    "read_header", "read_tolerant", "rename_columns", "scan_with_rejects",
]
