"""DataFrame -> DataFrame operators: models, metrics, filters, boards, statistics."""
