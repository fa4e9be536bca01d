"""Plans: the model DAG (raw -> staging -> dims -> fact -> marts) and loads."""
