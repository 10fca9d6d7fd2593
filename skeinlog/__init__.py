"""Federated log analytics on Spark: operators are functions from DataFrame to DataFrame or to Column."""
