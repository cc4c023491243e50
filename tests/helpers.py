def rows(df):
    """A frame's rows in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
