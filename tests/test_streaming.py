"""Incremental file ingest: new files only, restart-safe."""

import os

from ratelens.streaming.ingest import ingest_available


def _write(d, m, rows):
    with open(os.path.join(d, f"mv_{m:07d}.txt"), "w") as f:
        f.write(f"{m}:\n" + "".join(f"{c},{r},2005-01-0{c % 9 + 1}\n" for c, r in rows))


def test_incremental_ingest(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    _write(src, 1, [(5, 3), (6, 4)])
    _write(src, 2, [(7, 1)])
    t = ingest_available(spark, src, out, ck)
    assert sorted((r.movie_id, r.customer_id) for r in t.collect()) == [(1, 5), (1, 6), (2, 7)]
    _write(src, 3, [(8, 2), (9, 5)])
    t = ingest_available(spark, src, out, ck)  # restart from the checkpoint: only file 3 is new
    assert t.count() == 5
    assert dict(t.dtypes)["rating_date"] == "date"
