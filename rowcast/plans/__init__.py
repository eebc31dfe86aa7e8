"""Plan shapes shared by the operators: joins, row numbering, scratch tables."""
