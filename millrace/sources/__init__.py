from millrace.sources.contracts import StreamContract, infer_fields, infer_nested
from millrace.sources.landing import (
    append_landing,
    extract_increment,
    files_after_cursor,
    list_files,
    scan_files,
    scan_landing,
)

__all__ = [
    "StreamContract",
    "append_landing",
    "extract_increment",
    "files_after_cursor",
    "infer_fields",
    "infer_nested",
    "list_files",
    "scan_files",
    "scan_landing",
]
