"""Customer-churn analytics as DataFrame operators for PySpark."""
