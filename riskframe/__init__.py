"""riskframe: credit and payments risk analytics as Spark DataFrame operators."""
