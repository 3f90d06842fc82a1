"""A layered retail lakehouse as Spark DataFrame operators."""
