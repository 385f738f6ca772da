"""The analytics operators, one module per area."""
