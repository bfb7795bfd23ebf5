"""Shuffle bytes written per headline query, from Spark's event log.

Usage: python tools/shuffle_report.py [sf_dir] [event_log_dir]
Each query runs under its own job group; the event log (written to a scratch
folder, no UI or server involved) is then summed per group.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    log_dir = argv[1] if len(argv) > 1 else tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    from bench import HEADLINE
    from ratelens.plans.registry import load_all
    from ratelens.session import build_session
    spark = build_session(shuffle_partitions=16, extra={"spark.eventLog.enabled": "true",
                                                       "spark.eventLog.dir": f"file://{log_dir}",
                                                       "spark.eventLog.compress": "false"})
    entries = load_all()
    for k in HEADLINE:
        spark.catalog.clearCache()
        spark.sparkContext.setJobGroup(k, k)
        entries[k].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    stage_group, written, read_in = {}, {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sid = ev.get("Stage ID")
                    sw = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    ib = (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    written[sid] = written.get(sid, 0) + sw
                    read_in[sid] = read_in.get(sid, 0) + ib
    out = {}
    for sid, g in stage_group.items():
        if g is None:
            continue
        o = out.setdefault(g, {"shuffle_bytes": 0, "input_bytes": 0})
        o["shuffle_bytes"] += written.get(sid, 0)
        o["input_bytes"] += read_in.get(sid, 0)
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1:])
