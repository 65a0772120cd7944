"""Churn analytics for user activity logs, written as Spark DataFrame jobs."""
