"""Set-wise document-workflow analytics on PySpark."""
