"""Near copies never share a bin of the packing query."""

import os
from collections import Counter

from helpers import frame

from brewlens.llm import packing, queries


def test_near_copies_conflict(spark, tmp_path):
    base = [f"w{i}" for i in range(40)]
    near = [" ".join(base), "  ".join(base), " ".join(base[:-1] + ["other"]), " ".join(base).upper()]
    alone = [" ".join(f"u{k}x{i}" for i in range(40)) for k in range(8)]
    texts = near + alone + ["", None]
    data = [(i, t, "en", f"s{i}", 0) for i, t in enumerate(texts)] + [(None, near[0], "en", "t", 0), (3, near[2], "en", "t", 0)]
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op6_best_fit_packing(spark, str(tmp_path)).collect()
    assert len(out) == len(data)
    copies = [r for r in out if r["doc_id"] in (0, 1, 2, 3, None)]
    assert len(copies) == 6 and len({r["cluster"] for r in copies}) == 1
    assert len({r["bin_id"] for r in copies}) == 6
    assert len({r["bin_id"] for r in out if r["doc_id"] in (12, 13)}) == 2          # empty texts are copies too
    assert max(Counter((r["bin_id"], r["cluster"]) for r in out).values()) == 1


def test_cluster_column_is_taken(spark):
    docs = frame(spark, [(i, f"text {i}", "en", f"s{i}", 0) for i in range(4)]).selectExpr("*", "IF(doc_id < 3, 7L, NULL) AS given")
    out = packing.pack_documents(docs, cluster="given").collect()
    assert len({r["bin_id"] for r in out if r["doc_id"] < 3}) == 3
