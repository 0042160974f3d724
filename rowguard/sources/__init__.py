"""Sources and sinks: readers with partitioning/schema options, catalog
access, reference key sets, table/path/CSV writers."""
