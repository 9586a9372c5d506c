"""Jobs: the operators put together from source files to report."""
