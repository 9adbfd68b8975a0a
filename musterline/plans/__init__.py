"""How operators are put together: test-table bindings, stored layers and SQL functions."""
