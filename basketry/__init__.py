"""Retail customer analytics as Spark jobs: star schema, customer 360, RFM, cohorts, clusters, data quality."""
