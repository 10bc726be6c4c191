"""Column builders.  Every function takes and returns Columns; none is a UDF."""
