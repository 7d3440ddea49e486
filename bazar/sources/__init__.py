"""Where tables come from and go to: CSV, SQLite, the lake and the catalog."""

from bazar.sources.catalog import publish_layer, publish_table, query, register_views
from bazar.sources.csv import describe_csv, infer_csv_schema, preview_csv, read_csv
from bazar.sources.describe import describe
from bazar.sources.lake import Lake
from bazar.sources.sqlite import SqliteDataSource, read_sqlite

__all__ = [
    "Lake",
    "SqliteDataSource",
    "describe",
    "describe_csv",
    "infer_csv_schema",
    "preview_csv",
    "publish_layer",
    "publish_table",
    "query",
    "read_csv",
    "read_sqlite",
    "register_views",
]
