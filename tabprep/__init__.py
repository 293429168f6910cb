"""Preparation of business tables for reporting, as lazy Spark DataFrame expressions."""
