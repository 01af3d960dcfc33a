"""Marketplace sales analytics on PySpark: landed rows -> staging -> facts -> reports."""
