"""Sources and sinks: driver tables, the synthetic application view, delimited-text landing."""
