"""logloom: web-log analytics and anomaly detection on Spark DataFrames.

Every operator takes and returns a DataFrame (or fits a model from one).
Row-level work uses built-in Spark expressions; numpy runs only inside
executor tasks for the SOM and autoencoder maths.
"""

__version__ = "0.1.0"
