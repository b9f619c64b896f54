"""Sources and sinks: landing ingest, bronze scans, named layers, and the
mapping of the benchmark tables onto the four feeds."""
