def rows_of(docs):
    """(doc_id, text) in row order."""
    return [(r["doc_id"], r["text"]) for r in docs.orderBy("n").collect()]
