"""Landing-file scans (sources) and writers (sinks)."""
