"""shoplens — Spark-native analytics for online-shop data.

Every operator is a ``DataFrame -> DataFrame`` function built from built-in
Spark SQL expressions; nothing is collected to the driver.
"""

__version__ = "0.1.0"
