"""DuckDB SQL giving the expected result of every query that SQL can express.

Written independently of the Spark code: windows are separate CTEs with
COUNT(DISTINCT), blind spots are NOT EXISTS, curves are window functions.
"""
