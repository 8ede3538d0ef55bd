"""veridex: document-to-verified-facts analytics on PySpark DataFrames."""
