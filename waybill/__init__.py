"""waybill: a Spark-first lakehouse for logistics scan events."""
