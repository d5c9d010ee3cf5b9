"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing else in the library imports this subpackage.  Each module is one
operator; ``catalog`` holds their registered queries and the SQL they can be
checked against.  Every operator works on any table with an id column and a
text column and reads no other column.
"""
