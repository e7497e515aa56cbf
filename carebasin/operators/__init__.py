"""DataFrame operators. Each takes a DataFrame and returns a lazy one."""
