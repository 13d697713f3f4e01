"""DataFrame operators: merge, mutation, change feed, layout, access report."""
