"""Column functions built from Spark SQL built-ins (stay in whole-stage codegen)."""
