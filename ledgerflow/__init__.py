"""Transaction analytics as a library of PySpark DataFrame operators."""
