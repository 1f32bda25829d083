"""inkmill: document and knowledge-pipeline analytics on PySpark DataFrames."""
