"""Sources and sinks: explicit schemas, snapshot and window scans, CSV/TSV, adapters."""
