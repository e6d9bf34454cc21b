"""Read-only inspection of tables and checkpoints, and the registered queries."""
