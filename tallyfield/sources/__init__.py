"""Sources and sinks: raw JSON, CSV and spreadsheet-like grids, incremental scans, partitioned writes."""
