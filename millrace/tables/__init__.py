from millrace.tables.bucketed import BUCKETS, BucketedTable
from millrace.tables.table import TableStore, VersionedTable

__all__ = ["BUCKETS", "BucketedTable", "TableStore", "VersionedTable"]
