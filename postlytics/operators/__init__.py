"""DataFrame -> DataFrame operators: enrichment, scorers, filters, state, reports, extensions."""
