"""Every query of the library over the given tables, and its SQL counterpart."""
