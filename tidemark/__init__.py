"""tidemark: a PySpark-native engagement analytics engine.

Bronze scans -> silver staging -> gold marts -> quality checks and reports,
plus Structured Streaming for the event feed.  Everything is expressed with
DataFrames so Catalyst / AQE choose the physical plan.
"""

__version__ = "0.1.0"
