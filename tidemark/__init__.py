"""Lakehouse table operators and medallion jobs written as lazy Spark plans."""
