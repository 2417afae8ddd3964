"""DataFrame operators: staging, marts, survival (Kaplan-Meier), metrics, churn (Spark ML),
data quality and dashboard datasets.  Every function takes and returns DataFrames."""
