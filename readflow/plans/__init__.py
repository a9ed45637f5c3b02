"""Jobs built from the operators: the catalogue of queries and the batch pipeline."""
