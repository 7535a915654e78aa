"""Writers: event and summary tables, raw archive, exports, table upkeep."""
