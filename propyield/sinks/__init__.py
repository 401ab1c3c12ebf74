from propyield.sinks.files import export_csv, export_named_csv, materialize_for, materialize_once
from propyield.sinks.jdbc import write_jdbc
from propyield.sinks.publish import PART, Run, drop_old_runs, published

__all__ = ["PART", "Run", "drop_old_runs", "export_csv", "export_named_csv", "materialize_for", "materialize_once",
           "published", "write_jdbc"]
