"""Multi-source sales analytics on PySpark: feeds -> star schema -> rollups -> reports."""
