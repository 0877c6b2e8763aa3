"""tallymill: a retail medallion warehouse written as Spark DataFrame plans."""
