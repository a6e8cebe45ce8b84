"""Writers: files, catalog tables, and several sinks fed from the same rows."""
