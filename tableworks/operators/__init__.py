"""Table operators. Each one is a function ``f(df, *, param=default) -> DataFrame``."""
