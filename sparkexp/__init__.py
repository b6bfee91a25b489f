"""Binary-classification experiments on Spark, from the split by date to the report."""
