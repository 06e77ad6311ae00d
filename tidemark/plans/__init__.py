"""Jobs and table-building plans."""
