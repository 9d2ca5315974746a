"""Store-data consolidation as Spark DataFrame operators.

Every operator is a plain function from DataFrames to a DataFrame. Nothing in
``functions`` or ``operators`` runs a job; only ``sources`` and ``plans`` touch storage.
"""
