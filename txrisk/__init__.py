"""Customer risk scoring from payment transactions, as Spark jobs.

profile -> features -> label -> train -> evaluate -> score, over tables and over a stream.
Every public function takes and returns DataFrames and stays lazy unless its docstring says otherwise.
"""
