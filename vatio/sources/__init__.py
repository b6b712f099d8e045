"""Sources and sinks: raw contracts, landing files, partitioned tables."""
