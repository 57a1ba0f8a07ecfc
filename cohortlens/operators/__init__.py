"""DataFrame-to-DataFrame operators: joins, rates, quality, model, alerts."""
