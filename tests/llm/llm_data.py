"""Access to the given tables for the brute-force comparisons."""

import pyarrow.parquet as pq


def data(sf, name):
    return f"/root/testdata/{sf}/{name}.parquet"


def texts(sf):
    t = pq.read_table(data(sf, "documents"), columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
