"""DataFrame operators: `op(df, ..., parameters) -> DataFrame`, for use with `df.transform`."""
