"""Sources and sinks: driver tables, landed files, bronze partitions, planning."""
