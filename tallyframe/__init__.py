"""Statistical reports from coded administrative data, as Spark DataFrame plans."""
