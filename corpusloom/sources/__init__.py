"""Sources and sinks: driver-table adapters, JSONL, manifests, run records."""
