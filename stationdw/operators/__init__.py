"""DataFrame operators: cleaning, upserts, ranks, aggregates, checks, sizing."""
