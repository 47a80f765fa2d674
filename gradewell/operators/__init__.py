"""Table operators: columns, filters, joins, groups, picks, ranks."""
