"""Spark-native building blocks for dimensional warehouses and market benchmarks."""
