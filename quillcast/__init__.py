"""Windowed analytics of short social posts on Spark tables and streams."""
