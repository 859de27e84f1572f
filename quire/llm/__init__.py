"""Training-data operators: ten Spark jobs over text tables and the queries
that apply them. Nothing outside this subpackage imports it."""
