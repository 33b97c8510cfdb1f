"""SQL expression builders: text, numbers, dates and row hashes.

Each takes and returns SQL text, to be used with `F.expr` / `selectExpr`. A sheet has some
thirty text columns with a few nested expressions each: as text every column is one
parsed expression, where the same built call by call is hundreds of round trips to the JVM.
"""
