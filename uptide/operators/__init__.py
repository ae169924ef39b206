"""Table operators: every public function takes DataFrames and column names and stays lazy."""
