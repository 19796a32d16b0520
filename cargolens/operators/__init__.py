"""Frame to frame steps: cleaning, aggregation, ranking, risk, trends and quality."""
