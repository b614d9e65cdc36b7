"""Relational building blocks: columns, filters, joins, groups, sets, ranks, samples."""
