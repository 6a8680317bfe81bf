"""riskstream: transaction-risk scoring and reporting as Spark jobs."""
