"""DataFrame operators; names of columns are parameters wherever the meaning allows it."""
