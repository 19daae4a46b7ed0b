"""Queries over the test tables, one module per area: name -> (query, reference SQL or None)."""
