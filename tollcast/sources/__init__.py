from .csv import SCHEMAS, nan_to_null, read_csv, write_csv, write_parquet  # noqa: F401
from .inspect import head, schema_frame, shape_frame  # noqa: F401
from .tables import DRIVER_TABLES, register_view, register_views, sql, table  # noqa: F401
