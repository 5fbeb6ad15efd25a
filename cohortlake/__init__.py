"""Learner-activity analytics on Spark: Bronze, Silver and Gold layers, dashboards and models."""
