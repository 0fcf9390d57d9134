"""The query catalogue: every operator over the given tables, with its SQL counterpart."""
