"""The registered queries, their SQL counterparts and the trip view of the given tables."""
