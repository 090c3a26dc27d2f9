"""DataFrame operators: joins, groupings, sequence and tree work."""
