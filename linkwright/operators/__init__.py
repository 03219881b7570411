"""DataFrame to DataFrame operators of the linkage engine."""
