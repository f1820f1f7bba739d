"""Sources and sinks: feeds, ragged sheets, lookup tables and keyed tables."""
