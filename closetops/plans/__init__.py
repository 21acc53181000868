"""One module per report.  Every function takes DataFrames and explicit
parameters (``as_of``, date bounds, zones) and returns a lazy DataFrame."""
