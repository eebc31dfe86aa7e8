"""The registered queries: each binds the shared tables to a report."""
