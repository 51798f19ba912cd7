"""A Spark analytics engine for daily panel data: prices, signals, scoring, evaluation, holdings and data quality."""
