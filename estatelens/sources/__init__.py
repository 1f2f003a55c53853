"""Table sources: driver Parquet derivation and the brokerage table catalog."""

from estatelens.sources.driver_tables import AS_OF, DriverTables, driver_tables  # noqa: F401
