"""DataFrame-to-DataFrame operators: joins, ranks, samples, evaluation, drift."""
