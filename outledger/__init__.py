"""Billing-outbound analytics expressed as Spark DataFrame operators."""
