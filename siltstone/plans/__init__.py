"""Source plans: thin compositions of the operators, one function per table.

Every function takes and returns DataFrames and stays lazy. Tables keep the column names
under which the released data is known.
"""
