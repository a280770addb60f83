"""Operators of a training-data pipeline. Nothing outside this folder imports it.

Each module holds one operator; ``queries`` applies them to the test tables and
``oracle`` has the SQL of those that SQL can express.
"""
