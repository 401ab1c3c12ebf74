from propyield.streaming.aggregates import compact, keep_rent_means, keep_sales_totals
from propyield.streaming.ingest import each_batch_of_files, ingest_any_layout, ingest_available, stream_folder

__all__ = ["compact", "each_batch_of_files", "ingest_any_layout", "ingest_available", "keep_rent_means", "keep_sales_totals",
           "stream_folder"]
