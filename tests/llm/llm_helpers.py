"""Small frames for the operator tests."""

SF_SMALL = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents frame from ``(doc_id, text)`` or ``(doc_id, text, lang)`` rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def as_rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
