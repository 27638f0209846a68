"""Transit, rainfall and flood-risk analytics as Spark DataFrame operators."""
