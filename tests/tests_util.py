def one(df):
    """The single value of a one-row, one-column result."""
    return df.first()[0]
