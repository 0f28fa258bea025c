from tripmart.sources.catalog import Catalog
from tripmart.sources.load import backfill_date, file_health, load_raw
from tripmart.sources.scan import read_partitioned, read_trips, schema_report
from tripmart.sources.seeds import builtin_seed, read_seed
from tripmart.sources.sinks import materialize_view, write_partitioned, write_table

__all__ = ["Catalog", "backfill_date", "builtin_seed", "file_health", "load_raw", "materialize_view",
           "read_partitioned", "read_seed", "read_trips", "schema_report", "write_partitioned",
           "write_table"]
