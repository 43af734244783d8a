"""Stream and table analytics operators for PySpark: DataFrame in, DataFrame out."""
