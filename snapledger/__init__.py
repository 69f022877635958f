"""snapledger: versioned document snapshots as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame(s) + column names -> DataFrame``;
nothing here triggers a job unless its docstring says so.
"""
