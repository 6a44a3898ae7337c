"""End-to-end plans: the registered query catalog and the two feature
preparation flows (interaction log -> encoded fat table; daily sales log ->
prepared table), plus spark.ml models on top."""
