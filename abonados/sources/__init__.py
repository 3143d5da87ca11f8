"""Reading raw documents and storing the tables of each layer."""
