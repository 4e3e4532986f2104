"""Public-ledger analytics on Spark: land, check, flatten, classify, reconcile, publish."""
